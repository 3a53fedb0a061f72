import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from orderlens.llm.packing import (
    WordIds,
    _words,
    best_fit_decreasing,
    cut_into_pieces,
    least_bins,
    pack,
)

from .conftest import documents

ODD = [
    "", None, " \n", "a<|endoftext|>b <|ENDOFTEXT|> x", "é. café, —. x..",
    "don't. DON'T, I'll we've", "a b c​.", "İstanbul. ΣΣ. ẞ,", "ﬁ.́ x",
    "한글. 你好， 12.5, 1,000.", "<|startoftext|>.", "a.b, c.d.", "x" * 300 + " y", "\x1c a\x85b",
    "word " * 5000,
]


def ids_of(text):
    return [*ids_of_many([text or ""])[0], 0]


def ids_of_many(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_get_the_ids_of_the_whole_text():
    """Random texts of letters that change length in lower case or compose, signs, spaces of all
    kinds, contractions and special tokens."""
    rng = random.Random(1)
    pool = list("abcXYZ.,!?'\"()$%#-_<|>/ \n\t\x0b\x0c\x1c\x85\xa0​ ")
    pool += list("İıßẞéÉçñΣςσǅǆŉſKÅΩªºµ¹½٣一한글日本ﬁ́̇ͅȺɐʼＡ")
    pool += ["the", "'s", "n't", "...", ", ", "<|endoftext|>", "<|startoftext|>", "İ.", "Wörd. "]
    pool += [chr(c) for c in range(0xA0, 0x260)]
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        known = WordIds(f.read())
    assert known.model is not None
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    for text, whole in zip(texts, ids_of_many(texts), strict=True):
        words = _words(text.encode())
        known.learn(set(words))
        ids = np.frombuffer(b"".join(known.ids[w] for w in words), "<u4").tolist()
        assert ids == whole, text


def test_rows_without_an_id_are_dealt_apart(spark):
    """Pieces of one repeated or null id spread over partitions like any others."""
    docs = documents(spark, ["word " * 30] * 300, ids=[None] * 200 + [1] * 100)
    rows = pack(cut_into_pieces(docs), pieces_per_partition=20).collect()
    assert len(rows) == 300 and len({r["sequence_id"] >> 32 for r in rows}) > 3


def check(rows, texts):
    places = {}
    seen = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        ids = seen.setdefault(r["doc_id"], ids_of(texts[r["doc_id"]]))
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["start"] == 2048 * r["piece"] and len(part) == r["length"]
        assert r["length"] == min(2048, len(ids) - r["start"])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(seen) == set(texts)
    assert sum(r["length"] for r in rows) == sum(map(len, seen.values()))
    for sequence in places.values():
        end = 0
        for offset, length in sorted(sequence):
            assert offset == end
            end += length
        assert end <= 2048
    return len(places)


def test_pieces_and_places(spark, folder):
    table = pq.read_table(f"{folder}/documents.parquet")
    texts = dict(enumerate([*ODD, *table["text"].to_pylist()]))
    docs = documents(spark, list(texts.values()), ids=list(texts))
    rows = pack(cut_into_pieces(docs), pieces_per_partition=40).collect()
    sequences = check(rows, texts)
    assert sequences <= 1.01 * least_bins(np.array([r["length"] for r in rows]), 2048) + 1


def test_empty_and_repeated_rows(spark):
    assert pack(cut_into_pieces(documents(spark, []))).collect() == []
    docs = documents(spark, ["a b", "a b", "a b"], ids=[1, 1, None])
    rows = pack(cut_into_pieces(docs)).collect()
    assert len(rows) == 3 and len({r["sequence_id"] for r in rows}) == 1
    assert sorted(r["offset"] for r in rows) == [0, 3, 6]


def test_bounds_hold_and_are_met():
    rng = np.random.default_rng(1)
    for _ in range(200):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 40)))
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths)
        assert fill.max() <= capacity
        assert (offsets + lengths <= fill[bins]).all()
        assert -(-lengths.sum() // capacity) <= least_bins(lengths, capacity) <= len(fill)
    # Three pieces over half a bin need three bins; six over a third need three.
    assert least_bins(np.array([6, 6, 6]), 10) == 3
    assert least_bins(np.array([4] * 6), 11) == 3
    assert least_bins(np.zeros(0, int), 10) == 0
