import itertools

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from orderlens.llm.components import components
from orderlens.llm.near_dup import (
    COORDINATES,
    WordHashes,
    near_duplicates,
    shingles,
    sketch,
)

from .conftest import documents, prose


def shingle_set(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_force(rows):
    """doc_id -> (set size, smallest id reachable)."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i)) for i, s in sets}


def check(spark, rows):
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = near_duplicates(docs).collect()
    want = brute_force(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_equals_brute_force_on_hand_made_texts(spark):
    base = prose(1, 200).split()
    rows = [(7, " ".join(base)), (3, " ".join(base).upper()), (5, "\t".join(base))]
    # A group of near copies of each other, at and around the threshold.
    for k in range(40):
        copy = list(base)
        for j in range(k % 7):
            copy[(k * 37 + j * 29) % 200] = f"x{k}-{j}"
        rows.append((100 + k, " ".join(copy)))
    rows += [(200, ""), (201, None), (202, " \n "), (203, "one two"), (204, "One\ttwo"),
             (205, "one two three"), (206, "été dur a b c"), (207, "ÉTÉ dur a b c")]
    check(spark, rows)


def test_equals_brute_force_on_documents(spark, folder):
    table = pq.read_table(f"{folder}/documents.parquet")
    check(spark, list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)))


def test_empty_table_null_and_repeated_ids(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    same, other = prose(1), prose(2)
    got = near_duplicates(documents(spark, [same, same, other, same, None],
                                    ids=[None, 4, 4, 9, None]))
    rows = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got.collect()), key=repr)
    # Id 4 has two texts, which are one vertex.
    assert rows == sorted(
        [(None, None, True)] * 2 + [(4, 4, True)] * 2 + [(9, 4, False)], key=repr
    )


def test_sketches_estimate_the_similarity():
    hashes = WordHashes()
    for size in (1, 3, 50, 5000):
        x = shingles(" ".join(f"a{k}" for k in range(size + 4)).encode(), hashes)
        assert len(x) == size
        bins = sketch(x)
        assert len(bins) == COORDINATES and bins.max() < np.iinfo(np.uint64).max
        assert (sketch(x[::-1]) == bins).all()
    x = shingles(" ".join(f"a{k}" for k in range(1004)).encode(), hashes)
    share = (sketch(x[:900]) == sketch(x[100:])).mean()
    assert abs(share - 0.8) < 0.12


def test_components_of_chains_and_hubs(spark):
    chain = [(k, k + 1) for k in range(10, 60)]
    hub = [(1000, 1000 + k) for k in range(1, 50)] + [(1049, 5)]
    edges = spark.createDataFrame(chain + hub + [(3, 3)], "a long, b long")
    got = dict(components(edges).collect())
    assert set(got) == set(range(10, 61)) | set(range(1000, 1050)) | {5}
    assert {got[k] for k in range(10, 61)} == {10}
    assert {got[k] for k in range(1000, 1050)} == {5}
    assert components(edges.filter(F.lit(False))).collect() == []
