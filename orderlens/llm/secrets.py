"""Secrets in texts: permissive candidates, and a random forest that removes the false ones.

Everything here is DataFrame expressions and Spark's own forest; no Python runs on rows.

Candidates are long runs of key characters and shorter ones right after an assignment
sign. A candidate is described by its length, its kinds of characters and the changes
between them, how likely its character pairs are among labelled secrets and labelled
false findings, how much of it common words of the corpus cover, whether it looks like a
part of a path, the path of its text, and the words and signs next to it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.sources.scratch import written

# Labelled findings that the forest is grown on, at most (about), half of them per label.
TRAINING_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 7
DICTIONARY_WORDS = 256
NEIGHBOUR_WORDS = 1000
BEFORE, AFTER = 48, 24
MASK = "[SECRET]"

CANDIDATE = r"""(?<=[=:]["']?\s?["']?)[A-Za-z0-9+/_\-]{8,}={0,2}|[A-Za-z0-9+/_\-]{16,}={0,2}"""

# Names that credentials are assigned to, and published formats of keys.
ASSIGNED = (
    r"(?i)(token|secret|passw(or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key"
    r"""|credentials?|bearer|auth)["']?\s*[:=]?\s*["']?$"""
)
KNOWN_FORMAT = (
    r"^((AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35}|eyJ[A-Za-z0-9_\-]{16,})"
)
PATH_LIKE = r"(?i)(test|example|sample|doc|fixture|mock)"

NUMBERS = [
    "length", "digits", "capitals", "signs", "variety", "changes", "transitions", "coverage",
    "in_path", "path_of_tests", "assigned", "quoted", "named", "neighbour",
]


def _share(text: Column, pattern: str) -> Column:
    """Share of the characters that the pattern matches one by one."""
    rest = F.regexp_replace(text, pattern, "")
    return 1 - F.length(rest) / F.greatest(F.length(text), F.lit(1))


def candidates(docs: DataFrame, path_col: str | None = None) -> DataFrame:
    """(doc_id, text_key, candidate, start, occurrences, before, after, path) per text and
    distinct candidate; the surroundings are those of its first occurrence. ``start``
    counts characters from 0. A null or empty text has none. text_key tells texts with
    the same or no id apart."""
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    found = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64("text").alias("text_key"),
            F.col("text"),
            F.coalesce(path, F.lit("")).alias("path"),
            F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("_all"),
        )
        .filter(F.size("_all") > 0)
        .withColumn("candidate", F.explode(F.array_distinct("_all")))
    )
    start = F.instr(F.col("text"), F.col("candidate"))
    begin = F.greatest(start - BEFORE, F.lit(1))
    return found.select(
        "doc_id",
        "text_key",
        "candidate",
        (start - 1).cast("long").alias("start"),
        F.size(F.filter("_all", lambda x: x == F.col("candidate"))).alias("occurrences"),
        F.substring("text", begin, start - begin).alias("before"),
        F.substring("text", start + F.length("candidate"), F.lit(AFTER)).alias("after"),
        "path",
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """Candidates with ``label``: 1 if the candidate has a published key format, or holds
    digits and letters and is assigned to the name of a credential; 0 if it is only
    letters without a change of case inside, only digits, or only signs; else null."""
    c = F.col("candidate")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    secret = c.rlike(KNOWN_FORMAT) | (mixed & F.col("before").rlike(ASSIGNED))
    harmless = c.rlike(r"^([A-Za-z]?[a-z+/_\-]+|[A-Z+/_\-]+|[0-9+/_\-]+)=*$")
    return found.withColumn("label", F.when(secret, 1).when(harmless, 0).cast("int"))


def common_words(docs: DataFrame, most: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of three letters and more in all texts; at most ``most``."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w"))
    counts = words.filter(F.length("w") >= 3).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return [r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(most).collect()]


def _pairs(forms: DataFrame, *keep: str) -> DataFrame:
    """Adjacent characters of each candidate, one row each."""
    at = F.sequence(F.lit(1), F.length("candidate") - 1)
    pair = F.transform(at, lambda i: F.substring(F.col("candidate"), i, F.lit(2)))
    return forms.select(*keep, F.explode(pair).alias("pair"))


def _odds(positive: Column, negative: Column, all_pos: Column, all_neg: Column) -> Column:
    return F.log((positive + 1) / (all_pos + 2)) - F.log((negative + 1) / (all_neg + 2))


def _log_odds(labelled: DataFrame, key: str, most: int) -> DataFrame:
    """(key, odds): smoothed log-odds of a value among secrets and false findings, for the
    ``most`` frequent values."""
    counts = labelled.groupBy(key).agg(
        F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")
    )
    top = counts.orderBy(F.desc(F.col("p") + F.col("q")), key).limit(most)
    total = labelled.agg(F.sum("label").alias("_p"), F.sum(1 - F.col("label")).alias("_q"))
    sums = total.first()
    return top.select(
        key,
        _odds(F.col("p"), F.col("q"), F.lit(sums["_p"] or 0), F.lit(sums["_q"] or 0)).alias("odds"),
    )


def _neighbour(before: Column) -> Column:
    """The last word before the candidate, in lower case."""
    return F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1))


def _described(
    found: DataFrame, transitions: DataFrame, neighbours: DataFrame, words: list[str]
) -> DataFrame:
    """Candidates with the numbers that the forest reads. The two tables of odds have a
    bounded number of rows (pairs of key characters; frequent words)."""
    forms = found.select("candidate").distinct()
    likely = (
        _pairs(forms, "candidate")
        .join(F.broadcast(transitions), "pair", "left")
        .groupBy("candidate")
        .agg(F.avg(F.coalesce("odds", F.lit(0.0))).alias("transitions"))
    )
    c, before = F.col("candidate"), F.col("before")
    kinds = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "c"
    )
    changes = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1
    pattern = "|".join(sorted(words, key=lambda w: (-len(w), w))) if words else "(?!)"
    uncovered = F.regexp_replace(F.lower(c), pattern, "")
    shape = {
        "length": F.length(c).cast("double"),
        "digits": _share(c, "[0-9]"),
        "capitals": _share(c, "[A-Z]"),
        "signs": _share(c, r"[+/_=\-]"),
        "variety": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
        "changes": changes / F.length(c),
        "coverage": 1 - F.length(uncovered) / F.length(c),
    }
    described = forms.withColumns(shape).join(likely, "candidate", "left")
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    around = {
        "in_path": flag(c.rlike("/.*/") | before.rlike(r"(?i)([/\\@.]|https?:\S*)$")),
        "path_of_tests": flag(F.col("path").rlike(PATH_LIKE)),
        "assigned": flag(before.rlike(r"""[:=]\s*["']?$""")),
        "quoted": flag(before.rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "named": flag(before.rlike(ASSIGNED)),
    }
    return (
        found.join(described, "candidate")
        .withColumns(around)
        .withColumn("word", _neighbour(before))
        .join(F.broadcast(neighbours.withColumnRenamed("odds", "neighbour")), "word", "left")
        .fillna(0.0, ["transitions", "neighbour"])
    )


def _sample(labelled: DataFrame) -> DataFrame:
    """About half of ``TRAINING_FINDINGS`` rows of each label at most, chosen by a hash."""
    most = TRAINING_FINDINGS // 2
    part = F.pmod(F.xxhash64("candidate", "before", "after", F.lit("sample")), F.lit(1 << 30))
    limit = F.lit(1 << 30)
    for r in labelled.groupBy("label").count().collect():
        if r["count"] > most:
            least = int((1 << 30) * most / r["count"])
            limit = F.when(F.col("label") == r["label"], least).otherwise(limit)
    return labelled.filter(part < limit)


def _balanced(training: DataFrame, have: dict[int, int]) -> DataFrame:
    """Rows with a ``weight`` that gives both labels the same sum. The rows of a rare label
    are repeated, so that every tree's bootstrap sample holds them."""
    rare, often = sorted((0, 1), key=lambda label: have[label])
    copies = have[often] // have[rare]
    is_rare = F.col("label") == rare
    weight = F.when(is_rare, have[often] / (have[rare] * copies)).otherwise(1.0)
    times = F.when(is_rare, copies).otherwise(1)
    return training.withColumn("weight", weight).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), times))
    )


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    path_col: str | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """All candidates with the forest's verdict: doc_id, text_key, candidate, start,
    occurrences, probability, is_secret.

    ``findings`` are labelled ones (candidate, before, after, path, label); without them
    the candidates of ``docs`` are labelled by rules (``weak_labels``). The forest learns from
    a sample of about ``TRAINING_FINDINGS``, chosen by a hash for each label, and both labels
    weigh the same, however rare one is; the dictionary counts all texts.
    Without both labels the probability is the label's share, or 0 without any.

    Null and empty texts have no candidates; long texts are read whole; a null id is carried
    along; repeated rows give repeated findings; an empty table gives none; other columns are not
    read. Runs jobs.
    """
    found = written(candidates(docs, path_col), "candidates")
    labelled = weak_labels(found) if findings is None else findings
    labelled = labelled.filter("label IS NOT NULL").select(
        "candidate", "before", "after", F.coalesce("path", F.lit("")).alias("path"), "label"
    )
    labelled = written(_sample(labelled.distinct()), "labelled")
    have = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    result = ["doc_id", "text_key", "candidate", "start", "occurrences"]
    if len(have) < 2:
        share = F.lit(float(have.get(1, 0) > 0))
        return found.select(
            *result, share.alias("probability"), (share >= threshold).alias("is_secret")
        )
    words = common_words(docs)
    # Pairs of 67 key characters: 4,489 rows at most.
    transitions = written(
        _log_odds(_pairs(labelled, "label"), "pair", 67 * 67), "transitions"
    )
    neighbours = written(
        _log_odds(labelled.withColumn("word", _neighbour(F.col("before"))), "word",
                  NEIGHBOUR_WORDS),
        "neighbours",
    )
    vectors = VectorAssembler(inputCols=NUMBERS, outputCol="features")
    # The sample is bounded, and one sorted partition makes the forest reproducible.
    training = _described(labelled, transitions, neighbours, words)
    training = _balanced(training, have).repartition(1)
    training = training.sortWithinPartitions("candidate", "before", "after", "_copy")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt",
        weightCol="weight",
    ).fit(vectors.transform(written(training.select(*NUMBERS, "label", "weight"), "training")))
    scored = forest.transform(
        vectors.transform(_described(found, transitions, neighbours, words))
    )
    probability = vector_to_array("probability")[1]
    return scored.select(
        *result, probability.alias("probability"), (probability >= threshold).alias("is_secret")
    )


def redact(docs: DataFrame, scanned: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with every accepted secret replaced in ``text``; other rows and columns stay.
    Secrets meet their text by id and content, so rows without an id are redacted too."""
    secrets = (
        scanned.filter("is_secret")
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        .agg(F.collect_set("candidate").alias("_secrets"))
    )
    longest_first = F.transform(
        F.sort_array(
            F.transform("_secrets", lambda s: F.struct(-F.length(s), s.alias("s")))
        ),
        lambda x: x["s"],
    )
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    clean = F.aggregate(longest_first, F.col("text"), lambda t, s: F.replace(t, s, F.lit(mask)))
    return (
        docs.join(secrets, on, "left")
        .withColumn("text", F.when(F.col("_secrets").isNull(), F.col("text")).otherwise(clean))
        .select(*docs.columns)
    )
