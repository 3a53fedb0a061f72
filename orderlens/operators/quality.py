"""Data-quality checks. Each returns the rows that fail; no rows means passed."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import packed, unpacked
from orderlens.sources.scratch import written

# ---- rules on single rows: a condition that is true for a failing row ----


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(*values)


def not_positive(column: str, allow_zero: bool = True) -> Column:
    return F.col(column) < 0 if allow_zero else F.col(column) <= 0


def bad_email(column: str) -> Column:
    return ~F.col(column).like("%@%.%")


def in_future(column: str, as_of) -> Column:
    return F.col(column) > F.lit(as_of)


def not_matching(column: str, regex: str) -> Column:
    return ~F.col(column).rlike(regex)


def not_between(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


def failing(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule holds; a NULL value passes unless the rule asks for it."""
    return df.filter(rule)


# ---- rules on sets of rows ----


def duplicates(df: DataFrame, columns: Sequence[str], skip_null: bool = True) -> DataFrame:
    """Values (or value tuples) that occur more than once, with their number."""
    if skip_null:
        df = df.dropna(subset=list(columns))
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, skip_null: bool = True
) -> DataFrame:
    """Child rows without a parent row."""
    if skip_null:
        child = child.filter(F.col(column).isNotNull())
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return child.join(parents, F.col(column) == F.col("_parent"), "left_anti")


def wrong_type(df: DataFrame, column: str, expected: str) -> DataFrame:
    """One row with the number of values if the column is not of the expected type."""
    actual = df.schema[column].dataType
    wanted = T.DataType.fromDDL(expected)
    counted = df.agg(F.count(column).alias("n_values")).select(
        F.lit(column).alias("column_name"),
        F.lit(actual.simpleString()).alias("actual_type"),
        F.lit(wanted.simpleString()).alias("expected_type"),
        "n_values",
    )
    return counted.filter(F.lit(actual != wanted))


def order_total_mismatch(orders: DataFrame, items: DataFrame, tolerance=1) -> DataFrame:
    """Completed orders whose header total is not the sum of their items."""
    sums = items.groupBy("order_id").agg(F.sum("line_total").alias("calculated_total"))
    gap = F.abs(F.col("total_amount") - F.col("calculated_total"))
    return (
        orders.filter(F.col("order_status") == "completed")
        .select("order_id", "total_amount")
        .join(sums, "order_id")
        .withColumn("difference", gap)
        .filter(F.col("difference") > tolerance)
    )


def refund_above_limit(returns: DataFrame, items: DataFrame, factor: str = "1.1") -> DataFrame:
    """Returns refunded for more than ``factor`` times their item's total."""
    id_ = "order_item_id"
    totals = items.select(id_, F.col("line_total").alias("item_total"))
    returns = returns.select("return_id", id_, "refund_amount")
    limit = F.col("item_total") * F.lit(factor).cast("decimal(6,3)")
    # Text ids move in few bytes.
    text = dict(items.dtypes)[id_] == dict(returns.dtypes)[id_] == "string"
    if text:
        totals, returns = (df.withColumn(id_, packed(F.col(id_))) for df in (totals, returns))
    above = returns.join(totals, id_).filter(F.col("refund_amount") > limit)
    return above.withColumn(id_, unpacked(F.col(id_))) if text else above


def freshness(
    df: DataFrame, name: str, ts_col: str, as_of: Column, warn_hours: float, error_hours: float
) -> DataFrame:
    """One row: newest time, lag in hours at ``as_of``, and pass / warn / error."""
    newest = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("max_loaded_at"))
    seconds = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp("max_loaded_at")
    lag = seconds / F.lit(3600.0)
    status = (
        F.when(F.col("lag_hours").isNull() | (F.col("lag_hours") > error_hours), "error")
        .when(F.col("lag_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("lag_hours", lag).select(
        F.lit(name).alias("table_name"), "max_loaded_at", "lag_hours", status.alias("status")
    )


def row_count_change(
    before: DataFrame, after: DataFrame, max_change_pct: float = 50, min_rows: int = 100
) -> DataFrame:
    """One row if the number of rows changed too much or is below the minimum."""
    old = before.agg(F.count(F.lit(1))).scalar()
    counts = after.agg(F.count(F.lit(1)).alias("rows_after")).withColumn("rows_before", old)
    change = F.try_divide(
        F.abs(F.col("rows_after") - F.col("rows_before")) * F.lit(100.0), F.col("rows_before")
    )
    too_much = F.coalesce(F.col("change_pct") > max_change_pct, F.col("rows_after") > 0)
    return (
        counts.withColumn("change_pct", change)
        .filter(too_much | (F.col("rows_after") < min_rows))
        .select("rows_before", "rows_after", "change_pct")
    )


# ---- suites ----


@dataclass(frozen=True)
class Check:
    """A named check on one table: a row rule; a ``key`` that must be unique, or have a row in
    the ``parent`` (table, column); or a function from all tables to the failing rows."""

    table: str
    name: str
    rule: Column | None = None
    rows: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None
    severity: str = "error"
    key: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    skip_null: bool = True

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The failing rows, or the repeated values of a unique key."""
        df = tables[self.table]
        if self.rows is not None:
            return self.rows(tables)
        if self.rule is not None:
            return failing(df, self.rule)
        if self.parent is None:
            return duplicates(df, self.key, self.skip_null)
        parent, column = self.parent
        return orphans(df, self.key[0], tables[parent], column, self.skip_null)


def run_checks(
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check],
    counted: Mapping[str, Mapping[str, int]] | None = None,
    settled: bool = False,
) -> DataFrame:
    """``(table, check, severity, failures, status)`` per check. All row rules of a table are
    counted in one pass over it, unless ``counted`` has them already (``write_counted``),
    and all keys of one kind are compared in one shuffle.

    With ``settled``, results are made at once, by a job for the rules, one per name of a key
    and one per function, and only they are kept: the disk holds the shuffles of one of these
    jobs at a time. Unique text keys are then compared by hash first."""
    parts = []
    counted = counted or {}
    ruled = [c for c in checks if c.rule is not None]
    for table in dict.fromkeys(c.table for c in ruled):
        own = [c for c in ruled if c.table == table]
        if table in counted:
            spark = tables[table].sparkSession
            numbers = [F.lit(counted[table][c.name]) for c in own]
            results = [_result(c, n.cast("long")) for c, n in zip(own, numbers, strict=True)]
            parts.append(spark.range(1).select(F.inline(F.array(*results))))
        else:
            counts = tables[table].agg(
                *[F.count_if(c.rule).alias(f"_{i}") for i, c in enumerate(own)]
            )
            results = [_result(c, F.col(f"_{i}")) for i, c in enumerate(own)]
            parts.append(counts.select(F.inline(F.array(*results))))
    settle = (lambda df: written(df, "checked")) if settled else (lambda df: df)
    parts = [settle(reduce(DataFrame.unionByName, parts))] if parts else []
    keyed = [c for c in checks if c.key]
    if keyed:
        parts += [settle(part) for part in _key_results(tables, keyed, settled)]
    for c in checks:
        if c.rows is not None:
            count = c.rows(tables).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(settle(count.select(F.inline(F.array(_result(c, F.col("_n")))))))
    return reduce(DataFrame.unionByName, parts)


def _key_results(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], hashed: bool
) -> Iterator[DataFrame]:
    """Results of unique keys and parents, by name of the key. Columns that are compared form a
    space, like all order ids, and each space is one shuffle of its (key, source), counted before
    and after it: a source that has a key twice isn't unique, a child's source without the
    parent's is an orphan."""
    sources: dict[tuple, int] = {}

    def source(table: str, key: tuple[str, ...], with_null: bool) -> int:
        return sources.setdefault((table, key, with_null), len(sources))

    asked = []
    for c in checks:
        own = source(c.table, c.key, not c.skip_null)
        asked.append((c, own, None if c.parent is None else source(c.parent[0], (c.parent[1],), False)))
    space = list(range(len(sources)))
    for _, own, parent in asked:
        if parent is not None:
            low, high = sorted((space[own], space[parent]))
            space = [low if s == high else s for s in space]

    named: dict[tuple[str, ...], list[int]] = {}
    rows, texts = {}, set()
    for number in dict.fromkeys(space):
        members = [(s, at) for s, at in sources.items() if space[at] == number]
        named.setdefault(members[0][0][1], []).append(number)
        # Text is compared in few bytes, if all of the space is text.
        text = all(len(key) == 1 and tables[table].schema[key[0]].dataType == T.StringType()
                   for (table, key, _), _ in members)
        if text and len(members) == 1:
            texts.add(number)
        rows[number] = []
        for (table, key, with_null), at in members:
            value = F.col(key[0]) if len(key) == 1 else F.struct(*key)
            df = tables[table] if with_null else tables[table].dropna(subset=list(key))
            value = packed(value) if text else value
            rows[number].append(df.select(value.alias("key"), F.lit(at).alias("source")))
    for numbers in named.values():
        alone = [n for n in numbers if n in texts] if hashed else []
        for n, left in zip(alone, _with_equal_hashes([rows[n][0] for n in alone]), strict=True):
            rows[n] = [left]
        parts = []
        for number in numbers:
            mine = [a for a in asked if space[a[1]] == number]
            counts = {at: F.count_if(F.col("source") == at) for at in range(len(space)) if space[at] == number}
            by_key = reduce(DataFrame.union, rows[number]).groupBy("key").agg(
                *[n.alias(f"_n{at}") for at, n in counts.items()]
            )
            failures = []
            for i, (_, own, parent) in enumerate(mine):
                n = F.col(f"_n{own}")
                bad = F.when(n > 1, 1) if parent is None else F.when(F.col(f"_n{parent}") == 0, n)
                failures.append(F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias(f"_{i}"))
            results = [_result(c, F.col(f"_{i}")) for i, (c, _, _) in enumerate(mine)]
            parts.append(by_key.agg(*failures).select(F.inline(F.array(*results))))
        yield reduce(DataFrame.unionByName, parts)


# With more repeated hashes than a small broadcast holds, a join by them spares nothing.
FEW_HASHES = 10_000
# Fixed value: of 200 million keys, about 70 pairs have an equal hash by chance.
HASH_BITS = 48


def _with_equal_hashes(sources: Sequence[DataFrame]) -> list[DataFrame]:
    """Each source's rows of (key, source), without those whose key has a hash of its own and so
    is unique. A hash moves in half the bytes of a packed id; what is left is compared by key.
    Runs a job."""
    if not sources:
        return []
    value = F.shiftrightunsigned(F.xxhash64("key"), 64 - HASH_BITS).alias("hash")
    hashes = [
        df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").select("hash", F.lit(i).alias("of"))
        for i, df in enumerate(sources)
    ]
    repeated = written(reduce(DataFrame.union, hashes), "repeated")
    if repeated.count() > FEW_HASHES:
        return list(sources)
    return [
        df.withColumn("hash", value)
        .join(repeated.filter(F.col("of") == i), "hash", "left_semi")
        .select("key", "source")
        for i, df in enumerate(sources)
    ]


def write_counted(
    name: str, df: DataFrame, checks: Sequence[Check], columns: Sequence[str] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Write a table (or some of its columns) to the shared folder, and count on the way the
    rows that fail its row rules, by the checks' names."""
    ruled = [c for c in checks if c.table == name and c.rule is not None]
    seen = Observation(name)
    if ruled:
        df = df.observe(seen, *[F.count_if(c.rule).alias(f"_{i}") for i, c in enumerate(ruled)])
    out = df if columns is None else df.select(*columns)
    texts = [column for column, kind in out.dtypes if kind == "string"]
    out = written(out, name, texts)
    counts = seen.get if ruled else {}
    return out, {c.name: counts[f"_{i}"] for i, c in enumerate(ruled)}


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table"),
        F.lit(check.name).alias("check"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures == 0, "pass").otherwise(check.severity).alias("status"),
    )


@dataclass(frozen=True)
class Contract:
    """Declared shape of a table: types, non-null columns, key, and expressions that
    must hold for every row."""

    types: Mapping[str, str]
    not_null: Sequence[str] = ()
    primary_key: Sequence[str] = ()
    expressions: Sequence[str] = ()


def contract_checks(df: DataFrame, contract: Contract, table: str = "table") -> list[Check]:
    """The checks that a contract stands for."""
    checks = []
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for column, expected in contract.types.items():
        fits = fields.get(column) == T.DataType.fromDDL(expected).simpleString()
        checks.append(Check(table, f"type {column} {expected}", rule=F.lit(not fits)))
    for column in dict.fromkeys([*contract.not_null, *contract.primary_key]):
        if column in fields:
            checks.append(Check(table, f"not_null {column}", rule=is_null(column)))
    for text in contract.expressions:
        checks.append(Check(table, f"check {text}", rule=~F.expr(text)))
    if contract.primary_key and all(k in fields for k in contract.primary_key):
        name = "unique " + ",".join(contract.primary_key)
        checks.append(Check(table, name, key=tuple(contract.primary_key)))
    return checks
