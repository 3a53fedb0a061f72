"""Token counts that follow edits.

Every document has a segment tree over leaves of text. A leaf begins where the tokenizer
begins a pre-token whatever stands around it, so a document's tokens are those of its
leaves. An edit finds its leaves by the tree's character sums, re-encodes only these, with
a neighbour where the edit has made a border unsafe, and updates the sums up to the root.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import mapped

# Characters of a leaf: at least, and when a leaf that has grown is cut anew.
LEAF_CHARS = 512
LARGEST_LEAF = 8 * LEAF_CHARS

# One space between two signs that no one counts as white space. The pre-tokens of
# byte-level BPE hold a space only as their first character, and such a space always
# starts one.
BORDER = re.compile(r"(?<=\S) (?=\S)")


class Counter:
    """Counts tokens with a byte-level BPE vocabulary of ranks."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        pairs = map(bytes.split, ranks.splitlines())
        self.encoding = tiktoken.Encoding(
            "counts", pat_str=pattern, special_tokens={},
            mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs},
        )

    def __call__(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


def leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The text cut at the first border after every ``size`` characters; a text without
    borders is one leaf."""
    out, begin = [], 0
    while begin < len(text):
        border = BORDER.search(text, begin + size)
        end = border.start() if border else len(text)
        out.append(text[begin:end])
        begin = end
    return out


class TokenTree:
    """Sums of characters and tokens over a complete binary tree; node k has the children
    2k and 2k + 1, and leaf i is node ``width`` + i."""

    def __init__(self, chars: Sequence[int], tokens: Sequence[int]):
        self.size = max(1, len(chars))
        self.width = 1 << (self.size - 1).bit_length()
        self.sums = np.zeros((2, 2 * self.width), np.int64)
        self.sums[0, self.width : self.width + len(chars)] = chars
        self.sums[1, self.width : self.width + len(tokens)] = tokens
        low = self.width
        while low > 1:
            level = self.sums[:, low : 2 * low]
            self.sums[:, low // 2 : low] = level[:, 0::2] + level[:, 1::2]
            low //= 2

    chars = property(lambda self: int(self.sums[0, 1]))
    tokens = property(lambda self: int(self.sums[1, 1]))

    def leaf_at(self, place: int) -> int:
        """The leaf that holds character ``place``; the last used one for the end."""
        place = min(max(place, 0), max(self.chars - 1, 0))
        node = 1
        while node < self.width:
            node *= 2
            if place >= self.sums[0, node]:
                place -= self.sums[0, node]
                node += 1
        return min(node - self.width, self.size - 1)

    def begin(self, leaf: int) -> int:
        """Characters before a leaf."""
        node, before = self.width + leaf, 0
        while node > 1:
            if node % 2:
                before += int(self.sums[0, node - 1])
            node //= 2
        return before

    def length(self, leaf: int) -> int:
        return int(self.sums[0, self.width + leaf])

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.width + leaf
        change = np.array([chars, tokens]) - self.sums[:, node]
        while node:
            self.sums[:, node] += change
            node //= 2

    def leaf_sums(self) -> np.ndarray:
        """Characters and tokens of the leaves in use."""
        used = self.sums[:, self.width : self.width + self.size]
        return used[:, used[0] > 0]


def build_tree(text: str, count: Counter, size: int = LEAF_CHARS) -> TokenTree:
    parts = leaves(text, size)
    return TokenTree([len(p) for p in parts], [count(p) for p in parts])


def edit(
    text: str, tree: TokenTree, count: Counter, start: int, removed: int, inserted: str,
    size: int = LEAF_CHARS, largest: int = LARGEST_LEAF,
) -> tuple[str, TokenTree, int]:
    """Replace ``removed`` characters at ``start`` (both cut to the text): the new text, the
    tree, and how many characters were encoded again."""
    start = min(max(start, 0), len(text))
    end = min(max(start, start + removed), len(text))
    new = text[:start] + inserted + text[end:]
    grown = len(new) - len(text)
    first = tree.leaf_at(max(start - 1, 0))
    last = max(first, tree.leaf_at(end))
    low, high = tree.begin(first), tree.begin(last) + tree.length(last)

    # A border is safe if a space stands there between two other signs, in the new text.
    while low > 0 and not BORDER.match(new, low):
        first -= 1
        low -= tree.length(first)
    while high < len(text) and not BORDER.match(new, high + grown):
        last += 1
        high += tree.length(last)
    region = new[low : high + grown]
    tree.put(first, len(region), count(region))
    for leaf in range(first + 1, last + 1):
        tree.put(leaf, 0, 0)
    if len(region) > largest and BORDER.search(region, size):
        # Cut what has grown; the other leaves keep their counts.
        parts = leaves(region, size)
        sums = tree.sums[:, tree.width : tree.width + tree.size]
        middle = np.array([[len(p) for p in parts], [count(p) for p in parts]])
        tree = TokenTree(*np.concatenate([sums[:, :first], middle, sums[:, last + 1 :]], axis=1))
    return new, tree, len(region)


EDITS = "array<struct<start:long,removed:long,inserted:string>>"
COUNTED = (
    "doc_id long, n_tokens long, n_edits int, n_tokens_after long, chars_encoded long, "
    "text string, leaf_chars array<long>, leaf_tokens array<long>"
)


def _worker(ranks: bytes, pattern: str, kept: bool):
    """Counts texts, with or without known leaves, and applies their edits in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(ranks, pattern)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc, text, chars, tokens, edits in zip(
                *[c.to_pylist() for c in batch.columns], strict=True
            ):
                text = text or ""
                tree = build_tree(text, count) if chars is None else TokenTree(chars, tokens)
                before, encoded = tree.tokens, 0
                edits = [e for e in edits or [] if e is not None]
                for e in edits:
                    text, tree, work_done = edit(
                        text, tree, count, e["start"] or 0, e["removed"] or 0, e["inserted"] or ""
                    )
                    encoded += work_done
                sums = tree.leaf_sums()
                row = (doc, before, len(edits), tree.tokens, encoded, text if kept else None,
                       sums[0] if kept else None, sums[1] if kept else None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                [part.split()[0] for part in COUNTED.split(", ")],
            )

    return work


def _vocabulary(file: str | None, pattern: str | None) -> tuple[bytes, str]:
    import public_tokenizers

    with open(file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), pattern or public_tokenizers.PATTERN


def build(docs: DataFrame, ranks_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, text, leaf_chars, leaf_tokens, n_tokens of every document: its tree's leaves,
    from which the sums follow. A null text is empty and has no leaves."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
        F.lit(None).cast("array<long>"), F.lit(None).cast("array<long>").alias("t"),
        F.lit(None).cast(EDITS).alias("e"),
    )
    counted = mapped(rows, _worker(*_vocabulary(ranks_file, pattern), True), COUNTED)
    return counted.select("doc_id", "text", "leaf_chars", "leaf_tokens", "n_tokens")


def apply_edits(
    trees: DataFrame, edits: DataFrame, ranks_file: str | None = None, pattern: str | None = None
) -> DataFrame:
    """The trees after ``edits`` (doc_id, seq, start, removed, inserted), with n_tokens and
    chars_encoded. Edits of a document apply in the order of seq, each to the text that
    the one before left; places beyond the text are cut to it, null numbers are 0, a null
    text inserts nothing. Edits of unknown documents or without an id are ignored; rows
    that share an id all get the id's edits. A document's edits are gathered into one row,
    so a document with very many should get them in several calls."""
    listed = (
        edits.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.sort_array(F.collect_list(F.struct("seq", "start", "removed", "inserted")))
             .alias("_e"))
    )
    steps = F.transform("_e", lambda e: F.struct(
        e["start"].cast("long").alias("start"), e["removed"].cast("long").alias("removed"),
        e["inserted"].alias("inserted"),
    ))
    rows = trees.join(listed, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "text", "leaf_chars", "leaf_tokens", steps.alias("e")
    )
    counted = mapped(rows, _worker(*_vocabulary(ranks_file, pattern), True), COUNTED)
    return counted.select(
        "doc_id", "text", "leaf_chars", "leaf_tokens",
        F.col("n_tokens_after").alias("n_tokens"), "chars_encoded",
    )


def counts_through_edits(
    docs: DataFrame, edits_col: str, ranks_file: str | None = None, pattern: str | None = None
) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, chars_encoded of documents that carry
    their edits as an array of (start, removed, inserted): counted, edited and counted by
    the tree in one pass, without a shuffle. Null texts are empty; null edits none."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
        F.lit(None).cast("array<long>"), F.lit(None).cast("array<long>").alias("t"),
        F.col(edits_col).cast(EDITS).alias("e"),
    )
    counted = mapped(rows, _worker(*_vocabulary(ranks_file, pattern), False), COUNTED)
    return counted.select("doc_id", "n_tokens", "n_edits", "n_tokens_after", "chars_encoded")


def typical_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with ``edits``, made from each text itself: at three places that a hash of
    the text chooses, a replacement by a passage from elsewhere in the text, a removal and
    an insertion. Texts that are null or empty get none."""
    n = F.length("text").cast("long")
    at = lambda k: F.pmod(F.xxhash64("text", F.lit(k)), F.greatest(n, F.lit(1)))
    passage = lambda k, m: F.substring(F.col("text"), (at(k) + 1).cast("int"), F.lit(m))
    steps = [
        (at(1), F.lit(12), passage(2, 30)), (at(3), F.lit(40), F.lit("")),
        (at(4), F.lit(0), passage(5, 9)),
    ]
    listed = F.array(*[
        F.struct(s.alias("start"), r.cast("long").alias("removed"), i.alias("inserted"))
        for s, r, i in steps
    ])
    return docs.withColumn(
        "edits", F.when(n > 0, listed).otherwise(F.array().cast(EDITS))
    )
