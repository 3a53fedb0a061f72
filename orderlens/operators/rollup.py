"""Grouped rollups with exact distinct counts at several nested levels.

An order belongs to one customer and an item to one order. When a rollup counts
distinct items, orders and customers at once, the generic rewrite copies every row
once per distinct column. Here the rows are instead grouped step by step, finest
level first: at each step the id that has just become unique is counted and
dropped. Every step adds up partial results before its shuffle, the finest step
needs none when the rows already lie partitioned by that id, and a group that holds
a large part of all rows is spread over its ids until only sums are left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """What to compute of a group; ``value`` is an SQL expression over the input row."""

    kind: str
    value: str
    level: str | None = None


def total(value: str) -> Measure:
    return Measure("sum", value)


def smallest(value: str) -> Measure:
    return Measure("min", value)


def largest(value: str) -> Measure:
    return Measure("max", value)


def rows(when: str | None = None) -> Measure:
    """Number of rows, or of rows for which ``when`` holds."""
    return Measure("sum", "1" if when is None else f"if({when}, 1, 0)")


def distinct(level: str, when: str | None = None) -> Measure:
    """Number of distinct non-NULL ids of a nested level, among rows with ``when``."""
    seen = f"{level} IS NOT NULL"
    return Measure("distinct", seen if when is None else f"{seen} AND ifnull({when}, false)", level)


def nested_rollup(
    df: DataFrame,
    by: Sequence[str],
    nest: Sequence[str],
    measures: Mapping[str, Measure],
) -> DataFrame:
    """Group ``df`` by ``by``. ``nest`` names the ids below it from coarse to fine;
    each id must belong to one id of the level above. Without ``by`` the result is
    one row."""
    for name, m in measures.items():
        if m.kind == "distinct" and m.level not in nest:
            raise ValueError(f"{name}: {m.level!r} is not one of the levels {list(nest)}")

    def group(df: DataFrame, keys: Sequence[str], steps: Mapping[str, str]) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.expr(f"{step} AS {n}") for n, step in steps.items()])

    # Whether an id counts is a flag, largest at true, until its level is reached.
    start = {n: f"{'max' if m.kind == 'distinct' else m.kind}({m.value})" for n, m in measures.items()}
    out = group(df, [*by, *nest], start)
    for depth in reversed(range(len(nest))):
        steps = {}
        for name, m in measures.items():
            if m.kind != "distinct":
                steps[name] = f"{m.kind}({name})"
            elif m.level == nest[depth]:
                steps[name] = f"count_if({name})"
            else:
                steps[name] = f"{'sum' if m.level in nest[depth:] else 'max'}({name})"
        out = group(out, [*by, *nest[:depth]], steps)
    return out


def one_row(spark, *parts: DataFrame) -> DataFrame:
    """Put one-row results side by side as scalar subqueries, without a join."""
    out = spark.range(1)
    names = []
    for i, part in enumerate(parts):
        out = out.withColumn(f"_part{i}", part.select(F.struct(*part.columns)).scalar())
        names += [F.col(f"_part{i}.{c}").alias(c) for c in part.columns]
    return out.select(*names)
