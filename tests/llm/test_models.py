"""Toxicity and quality: held-out accuracy, and defined results for odd rows."""

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import quality, toxicity

from .conftest import documents, held_out, prose

LABELS = "doc_id long, toxic int, quality int"


@pytest.fixture(scope="module")
def corpus(spark):
    """Toxic documents hold two of three bad words in one sentence, at random; bad documents
    repeat one sign after every word."""
    texts, labels = [], []
    for k in range(240):
        sentences = [prose(k * 10 + j, 8) for j in range(5)]
        toxic, good = k % 4 == 0, k % 3 != 0
        if toxic:
            bad = ["grumblo", "snarkish", "vilehead"]
            sentences[k % 5] += f" {bad[k % 3]} and {bad[(k + 1) % 3]}"
        text = ". ".join(sentences)
        texts.append(text if good else text.replace(" ", "%%% "))
        labels.append((k + 1, int(toxic), int(good)))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS), texts, labels


def accuracy(rows, truth):
    apart = [r for r in rows if held_out(r["doc_id"])]
    assert len(apart) > 20 and all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    return np.mean([r["predicted"] == truth[r["doc_id"]] for r in apart])


def test_toxicity_on_held_out_documents(corpus):
    docs, labels, texts, truth = corpus
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model)
    rows = scored.collect()
    assert accuracy(rows, {d: t for d, t, _ in truth}) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    blamed = toxicity.offending_sentences(docs, scored).collect()
    assert blamed
    assert np.mean([any(w in r["sentence"] for w in ("grumblo", "snarkish", "vilehead"))
                    for r in blamed]) > 0.95
    assert all(texts[r["doc_id"] - 1].startswith(r["sentence"], r["start"]) for r in blamed)


def test_quality_on_held_out_documents(corpus):
    docs, labels, _, truth = corpus
    model = quality.train(docs, labels)
    assert model.temperature > 0
    rows = quality.score(docs, model).collect()
    assert accuracy(rows, {d: q for d, _, q in truth}) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_odd_rows_and_missing_labels(spark, corpus):
    _, labels, _, _ = corpus
    docs = documents(spark, ["", None, "word", "word"], ids=[1, 2, None, 2])
    none = labels.limit(0)
    for module, alone in ((toxicity, 0.0), (quality, 1.0)):
        for empty in (none, labels.selectExpr("doc_id", "null AS toxic", "null AS quality")):
            model = module.train(docs, empty)
            got = module.score(docs, model).collect()
            assert len(got) == 4 and {r["score"] for r in got} == {alone}
        assert module.score(docs.limit(0), model).collect() == []


def test_labels_of_held_out_documents_are_not_read(spark, corpus):
    docs, labels, _, _ = corpus
    apart = spark.createDataFrame([(k, 1, 1) for k in range(1, 241) if held_out(k)], LABELS)
    assert toxicity.train(docs, apart).constant == 0.0
    changed = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic"
    )
    assert toxicity.train(docs, labels) == toxicity.train(docs, changed)


def test_gradient_of_the_noisy_or():
    """One document with one bad sentence, one without: the bad word gets the blame."""
    rows = pa.table({
        "label": [1, 0, 1, 0], "sentences": [5, 5, 3, 9],
        "place": [[2], [1], [0, 1], []], "feature": [[0], [1], [0, 1], []],
    })
    weights, _, bias = toxicity._fit(rows, 2)
    assert weights[0] > 3 and weights[1] < 0.5 and bias < -4


def test_word_vectors_count_neighbours_within_a_text():
    vectors = list(quality._added(iter([pa.record_batch({"text": ["a b", None, "", "c"]})])))[0]
    assert set(vectors["row"].to_pylist()) == {quality.row_of("a"), quality.row_of("b")}
