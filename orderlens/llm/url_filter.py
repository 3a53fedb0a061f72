"""Allow or block URLs: by rules on host and path, else by gradient-boosted trees.

The trees read numbers of the URL's form and what labelled URLs say about its host's
suffixes. They learn from labelled URLs, by default those that a rule judges.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import is_held_out, written

ALLOW, BLOCK = "allow", "block"

# Labelled URLs that the trees learn from, half of them of each label at most.
TRAINING_URLS = 40_000
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 11
# Labelled URLs that the overall share weighs against those of a suffix.
PRIOR_WEIGHT = 10.0
SUFFIX_LABELS = (1, 2, 3)
# The suffixes of a training URL are counted in the other folds, so that its own label tells
# nothing; those of a URL to be judged in all.
FOLDS, ALL = 5, -1

FORM = [
    "length", "host_length", "path_length", "depth", "labels", "digits", "host_digits",
    "hyphens", "capitals", "entropy", "host_entropy", "parameters", "query_length", "fragment",
]
SUFFIX = [f"{kind}{n}" for n in SUFFIX_LABELS for kind in ("share", "seen")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_and_path(urls: DataFrame, url: str = "url") -> DataFrame:
    """``host``, in lower case, and ``path``; both empty for a null URL or one without ://"""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return urls.withColumns({
        "host": F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")),
        "path": F.coalesce(path, F.lit("")),
    })


def _suffix(host: Column, labels: int) -> Column:
    """The last labels of a host that has so many, else null."""
    found = F.substring_index(host, ".", -labels)
    return F.when((F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))) >= labels - 1,
                  found)


def with_rule(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``rule`` and its ``verdict`` for rows with ``host`` and ``path``: of the rules (like
    ``example.org/es/``) whose host is the row's or one above it and whose path starts the
    row's, the longest one, of equally long ones the last by its bytes; else null.

    A rule is looked up by equality: rules of one form (labels of the host, length of the path)
    are one join, on the row's suffix of so many labels and its path's beginning of that
    length. So rules may be many, as long as their forms are few. Spark ships a small side by
    its own check of the size."""
    spark = urls.sparkSession
    forms: dict[tuple[int, int], list[tuple[str, str]]] = {}
    for text, verdict in dict(rules).items():
        host, slash, path = text.partition("/")
        forms.setdefault((host.count(".") + 1, len(slash + path)), []).append((text, verdict))
    best = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    columns = urls.columns
    for k, ((labels, length), some) in enumerate(sorted(forms.items())):
        key = F.concat(_suffix(F.col("host"), labels), F.substring("path", 1, length))
        of_form = spark.createDataFrame(
            pa.table([list(c) for c in zip(*some, strict=True)], [f"_rule{k}", f"_verdict{k}"])
        )
        urls = urls.withColumn(
            f"_key{k}", F.when(F.length("path") >= length, key)
        ).join(of_form, F.col(f"_key{k}") == F.col(f"_rule{k}"), "left")
        found = F.struct(
            F.length(f"_rule{k}").alias("size"), F.col(f"_rule{k}").alias("rule"),
            F.col(f"_verdict{k}").alias("verdict"),
        )
        best = F.greatest(best, F.when(F.col(f"_rule{k}").isNotNull(), found))
    return urls.withColumn("_best", best).select(
        *columns, F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("verdict")
    )


def _entropy(text: bytes) -> float:
    """Bits per byte."""
    if not text:
        return 0.0
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / len(text)
    shares = shares[shares > 0]
    return float(-(shares * np.log2(shares)).sum())


def form_of(url: bytes, host: bytes, path: bytes) -> tuple[float, ...]:
    """The numbers ``FORM`` of one URL."""
    digits = lambda s: sum(s.count(d) for d in b"0123456789") / (len(s) or 1)
    before, _, fragment = url.partition(b"#")
    query = before.partition(b"?")[2]
    capitals = len(url) - len(url.translate(None, UPPER.encode()))
    return (
        len(url), len(host), len(path), path.count(b"/"), host.count(b".") + bool(host),
        digits(url), digits(host), url.count(b"-"), capitals, _entropy(url), _entropy(host),
        sum(1 for p in query.split(b"&") if p), len(query), float(bool(fragment)),
    )


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(n).cast(pa.binary()).to_pylist() for n in ("_url", "host", "path")]
        numbers = np.array([form_of(*row) for row in zip(*columns, strict=True)], np.float64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(c) for c in numbers.reshape(-1, len(FORM)).T)],
            [*batch.schema.names, *FORM],
        )


def _with_form(urls: DataFrame) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    return urls.mapInArrow(_forms, schema + "".join(f", {n} double" for n in FORM))


def _with_suffixes(urls: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    """How many labelled URLs share each suffix and which part of them is blocked, as far as
    they were counted for the row's ``fold``."""
    for n in SUFFIX_LABELS:
        of_n = stats.filter(F.col("labels") == n).select(
            F.col("suffix").alias("_suffix"), F.col("fold").alias("_fold"),
            F.col("seen").alias("_seen"), F.col("blocked").alias("_blocked"),
        )
        same = (_suffix(F.col("host"), n) == F.col("_suffix")) & (F.col("fold") == F.col("_fold"))
        urls = urls.join(of_n, same, "left")
        seen, blocked = F.coalesce("_seen", F.lit(0.0)), F.coalesce("_blocked", F.lit(0.0))
        urls = urls.withColumns({
            f"share{n}": (blocked + PRIOR_WEIGHT * prior) / (seen + PRIOR_WEIGHT),
            f"seen{n}": F.log1p(seen),
        }).drop("_suffix", "_fold", "_seen", "_blocked")
    return urls


class Model:
    """Trees, suffix statistics and the blocked share of the labelled URLs. Without both
    labels there are no trees, and every score is that share (0 without any label)."""

    def __init__(
        self, prior: float, stats: DataFrame | None = None, trees: GBTClassificationModel | None = None
    ):
        self.prior, self.stats, self.trees = prior, stats, trees


def train(labelled: DataFrame, held_out: Column | None = None) -> Model:
    """Learn from rows (host, path, _url, label), label 1 for blocked, but not from those that
    are ``held_out``. The sample is chosen for each label by a hash of the URL, and its rows stand
    for all of their label. Runs jobs."""
    if held_out is not None:
        labelled = labelled.filter(~held_out)
    # Copies of a URL count once, so that no label's sample fills with them.
    labelled = labelled.select("_url", "host", "path", F.col("label").cast("int").alias("label"))
    labelled = labelled.filter(F.col("label").isin(0, 1)).distinct()
    most = TRAINING_URLS // 2
    part = F.pmod(F.xxhash64("_url", F.lit("sample")), F.lit(1 << 30))
    limit, weight = F.lit(1 << 30), F.lit(1.0)
    have = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    for label, n in have.items():
        if n > most:
            of_label = F.col("label") == label
            limit = F.when(of_label, int((1 << 30) * most / n)).otherwise(limit)
            weight = F.when(of_label, n / most).otherwise(weight)
    prior = have.get(1, 0) / max(1, sum(have.values()))
    if len(have) < 2:
        return Model(prior)
    fold = F.pmod(F.xxhash64("_url", F.lit("fold")), F.lit(FOLDS)).cast("int")
    sample = labelled.filter(part < limit).withColumns({"weight": weight, "fold": fold})
    sample = written(sample, "labelled_urls")
    suffixes = F.array(*(
        F.struct(F.lit(n).alias("labels"), _suffix(F.col("host"), n).alias("suffix"))
        for n in SUFFIX_LABELS
    ))
    stats = written(
        sample.select("label", "weight", "fold", F.explode(suffixes).alias("s"))
        .filter("s.suffix IS NOT NULL")
        .withColumn("counted", F.explode(F.sequence(F.lit(ALL), F.lit(FOLDS - 1))))
        .filter("counted <> fold")
        .groupBy("s.labels", "s.suffix", F.col("counted").alias("fold"))
        .agg(F.sum("weight").alias("seen"), F.sum(F.col("weight") * F.col("label")).alias("blocked")),
        "suffixes",
    )
    described = _with_suffixes(_with_form(sample), stats, prior)
    # The sample is bounded, and one sorted partition makes the trees reproducible.
    rows = written(
        described.repartition(1).sortWithinPartitions("_url", "label")
        .select(*FORM, *SUFFIX, "label", "weight"),
        "training_urls",
    )
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, weightCol="weight"
    ).fit(VectorAssembler(inputCols=FORM + SUFFIX, outputCol="features").transform(rows))
    return Model(prior, stats, trees)


def score(urls: DataFrame, model: Model) -> DataFrame:
    """``score`` of rows with (host, path, _url): the trees' probability that it is blocked."""
    if model.trees is None:
        return urls.withColumn("score", F.lit(float(model.prior)))
    columns = urls.columns
    # Each sampled URL has one suffix of each length, which bounds what is broadcast.
    stats = F.broadcast(model.stats.filter(F.col("fold") == ALL))
    described = _with_suffixes(
        _with_form(urls).withColumn("fold", F.lit(ALL)), stats, model.prior
    )
    vectors = VectorAssembler(inputCols=FORM + SUFFIX, outputCol="features")
    scored = model.trees.transform(vectors.transform(described))
    return scored.select(*columns, vector_to_array("probability")[1].alias("score"))


def judge(
    spark: SparkSession,
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, held_out) per row: the verdict is the
    rule's, else ``block`` where the trees' score reaches ``threshold``.

    ``labelled`` are URLs (url, label), label 1 for blocked; without them the trees learn from
    the rows that a rule judges, but for the held-out fifth by page_id. Of the labelled URLs
    about ``TRAINING_URLS`` train the trees, chosen by a hash.

    A null URL, or one without ://, has an empty host and path, fits no rule and is scored like
    an empty one. Long URLs are read whole. Null and repeated ids are carried along, repeated
    rows give repeated rows, an empty table gives none; other columns are not read. Without
    labelled URLs all scores are 0, with one label only they are that label. Runs jobs.
    """
    plain = with_host_and_path(
        pages.select("page_id", F.coalesce("url", F.lit("")).alias("_url")), "_url"
    )
    ruled = with_rule(plain, rules).withColumn("held_out", is_held_out(F.col("page_id")))
    if labelled is None:
        known = ruled.filter("rule IS NOT NULL").withColumn(
            "label", (F.col("verdict") == BLOCK).cast("int")
        )
        model = train(known, F.col("held_out"))
    else:
        known = labelled.select(F.coalesce("url", F.lit("")).alias("_url"), "label")
        model = train(with_host_and_path(known, "_url"))
    learnt = F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)
    return score(ruled, model).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", learnt).alias("verdict"),
        "score", "held_out",
    )
