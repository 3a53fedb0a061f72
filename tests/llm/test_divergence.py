"""Divergence of sources against brute force, and defined results for odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderlens.llm import divergence
from orderlens.llm.divergence import SCALE, Stripes, divergences, share, words_of

DOC = "doc_id long, text string, lang string, source string, n_chars long, term long, rank string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(rows, least, smoothing, top):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        counts[lang, source].update(terms_of(text))
        docs[lang].update(set(terms_of(text)))
    result = set()
    for lang in {lang for lang, _ in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = [s for own, s in counts if own == lang]
        of = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        all_of = {t: sum(of[s][t] for s in sources) for t in kept}

        def shares(c):
            n = sum(c.values()) + smoothing * len(kept)
            return {t: 1 + SCALE * (c[t] + smoothing) // n for t in kept}

        p, q = {s: shares(of[s]) for s in sources}, shares(all_of)
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            over = [(t, p[s][t] - q[t]) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                result |= {
                    (lang, s, part, item, value, k + 1)
                    for k, (item, value) in enumerate(found[:most])
                }
    return result


def rows_of(seed, n):
    rng = random.Random(seed)
    words = ["Ab", "aB", "ab's", "naïve", "İ", "x9y", "日本", "É", "é", "q_r"] + [
        f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)
    ]
    rows = []
    for k in range(n):
        text = " ".join(rng.choice(words[: rng.choice([10, 40, 70])]) for _ in range(rng.randint(0, 30)))
        rows.append((
            rng.choice([k, 7, None]), rng.choice([text, text, text, None, ""]),
            rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "ü", None]),
            1, 2, "x",
        ))
    return rows + [(5, None, "empty", "one", 1, 2, "x"), (6, "", "empty", "two", 1, 2, "x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = rows_of(seed, 150)
    rows += rows[:9]
    docs = spark.createDataFrame(rows, DOC).repartition(5)
    found = divergences(docs, least_docs=3, smoothing=2, top_terms=7).collect()
    assert {tuple(r) for r in found} == brute(rows, 3, 2, 7)
    assert len(found) == len(brute(rows, 3, 2, 7))


def test_small_stripes_merge_to_the_same_rows(spark, monkeypatch):
    rows = rows_of(3, 120)
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    monkeypatch.setattr(divergence, "SPILL_ENTRIES", 5)
    monkeypatch.setattr(divergence, "CELLS", 8)
    found = divergences(docs, 2, 5, 50)
    assert {tuple(r) for r in found.collect()} == brute(rows, 2, 5, 50)


def test_empty_table_and_no_common_terms(spark):
    empty = divergences(spark.createDataFrame([], DOC))
    assert empty.collect() == []
    rows = [(1, "one two", "en", "a", 1, 1, ""), (2, "three", "en", "b", 1, 1, "")]
    few = divergences(spark.createDataFrame(rows, DOC))
    assert few.dtypes == empty.dtypes
    assert {tuple(r) for r in few.collect()} == {
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)
    }


def test_long_texts_are_cut_at_signs_outside_terms(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 16)
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("aB é日-7 ") * rng.choice([1, 1, 9]) for _ in range(40))
        cut = [w.decode() for words in words_of(text.encode()) for w in words]
        assert cut == terms_of(text)
    assert [len(w) for ws in words_of(b"x" * 100_000) for w in ws] == [100_000]


def test_one_word_a_million_times(spark):
    rows = [(1, "go " * 1_000_000, "en", "a", 1, 1, ""), (2, "stay", "en", "b", 1, 1, "")]
    found = divergences(spark.createDataFrame(rows, DOC), least_docs=1)
    assert {tuple(r) for r in found.collect()} == brute(rows, 1, 5, 50)


def test_shares_are_exact_beyond_floats():
    counts = np.array([0, 1, 10**14 + 7, 3 * 10**15 + 1], np.int64)
    total, terms = 8 * 10**15 + 3, 9
    assert share(counts, total, 5, terms).tolist() == [
        1 + SCALE * (int(c) + 5) // (total + 5 * terms) for c in counts
    ]


def test_a_full_task_hands_its_stripes_on():
    stripes = Stripes()
    stripes.add("en", "a", b"x y x")
    stripes.add("en", "b", b"X")
    stripes.add("de", "a", b"x")
    assert stripes.entries == 4
    rows = [r for batch in stripes.spill() for r in batch.to_pylist()]
    assert stripes.entries == 0 and not stripes.docs
    assert {(r["lang"], r["term"], r["docs"], *zip(r["sources"], r["counts"])) for r in rows} == {
        ("en", "x", 2, ("a", 2), ("b", 1)), ("en", "y", 1, ("a", 1)), ("de", "x", 1, ("a", 1))
    }
