import os
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from compare import compare

import __spark_entry__ as entry
import corpus_pipeline
from orderlens.llm import decontaminate, queries
from orderlens.sources import written

from .conftest import documents, prose
from .test_near_dup import shingle_set


def test_every_operator_is_registered():
    numbers = [name.split("_")[0] for name in queries.QUERIES]
    assert numbers == [f"op{n}" for n in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", queries.STATEMENTS)
def test_query_equals_sql(spark, folder, name):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    verdict, _ = compare(spark, con, folder, name)
    assert verdict.startswith("ok"), verdict


def test_stages_keep_clean_documents_and_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name)
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
        if name != "packing":
            assert docs.columns == columns
            assert docs.count() == len(kept[name])
        if name == "secrets":
            texts = docs.select("text", "n_chars").collect()
            assert not any('token = "' in t and '"[SECRET]"' not in t for t, _ in texts)
            assert all(len(t) == n for t, n in texts)
    names = list(kept)
    for before, after in zip(names, names[1:], strict=False):
        assert kept[after] <= kept[before]
    assert kept["secrets"] == kept["decontamination"] == kept["packing"]

    labels = pq.read_table(f"{folder}/labels.parquet").to_pylist()
    harmless = {r["doc_id"] for r in labels if r["toxic"] == 0}
    assert len(harmless & kept["toxicity"]) >= 0.98 * len(harmless)

    # Decontamination removes what holds most 4-grams of an item, and nothing else.
    items = [decontaminate.words(r["text"]) for r in
             pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    items = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in items]
    documents = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    leaked = set()
    for r in documents:
        w = decontaminate.words(r["text"])
        grams = {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
        if any(s and len(s & grams) >= 0.8 * len(s) for s in items):
            leaked.add(r["doc_id"])
    assert kept["decontamination"] == kept["near_duplicates"] - leaked


def test_near_duplicate_stage_equals_brute_force_at_its_similarity(spark, folder):
    table = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    texts = [r["text"] for r in table]
    for k in range(12):
        words = prose(k + 50, 200).split()
        copy = list(words)
        # 2 to 5 of 200 words apart, over 10 shingles: similarities from 0.9 down to 0.77.
        for j in range(2 + k % 4):
            copy[20 + 37 * j] = f"x{k}-{j}"
        texts += [" ".join(words), " ".join(copy)]
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    between = 0
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                between += 100 * len(x & y) < 85 * len(x | y)
                small, large = sorted((root[a], root[b]))
                root = [small if r == large else r for r in root]
    assert between >= 3
    docs = documents(spark, texts)
    kept = corpus_pipeline.distinct_documents(spark, docs, folder)
    want = {i + 1 for i, r in enumerate(root) if r == i}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_odd_rows_pass_all_stages(spark, folder):
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, None, "en", "s", 0),
            (2, "same words in a short text", "en", "s", 1),
            (2, "same words in a short text", "en", "s", 1),
            (3, "Same words in a SHORT text", "en", "s", 1), (4, "x" * 100_000, "en", "s", 1)]
    for docs, left in ((spark.createDataFrame(rows, schema), [None, None, 1, 2, 4]),
                       (spark.createDataFrame([], schema), [])):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, folder), name)
            ids = sorted((r["doc_id"] for r in docs.select("doc_id", *docs.columns[1:2]).collect()),
                         key=lambda i: (i is not None, i))
            if name in ("near_duplicates", "decontamination", "secrets"):
                assert ids == left
        assert {r["doc_id"] for r in docs.collect()} == set(left)


def test_rows_are_rejected_by_id_and_text(spark, folder):
    """A leak goes with or without an id, and takes no other row of its id along."""
    item = pq.read_table(f"{folder}/benchmark.parquet")["text"][0].as_py()
    texts = [f"{prose(1, 30)} {item}", prose(2, 30), f"{prose(3, 30)} {item}", prose(4, 30)]
    docs = documents(spark, texts, ids=[7, 7, None, None]).withColumnRenamed("digest", "_rejected")
    kept = corpus_pipeline.decontaminated(spark, docs, folder)
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(7, texts[1]), (None, texts[3])}


def test_run_ends_with_packed_sequences(spark, folder):
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py"))
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "packing"
    ]
