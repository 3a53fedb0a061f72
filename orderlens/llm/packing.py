"""Best-fit packing of tokenized documents, certified by lower bounds.

Documents are tokenized and cut into pieces of at most one sequence. Pieces are dealt by
a hash to partitions of bounded size, and each partition is packed by best-fit
decreasing. Dual-feasible functions give a lower bound for the number of sequences that
*any* packing of the partition needs; a partition that meets its bound is optimal and
done. Partitions with a gap give up their sequences that aren't full, and every partition
its emptiest one; these documents are dealt anew and packed again, which is kept if it
takes fewer sequences.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import gathered, mapped, utf8
from orderlens.sources.scratch import written

CAPACITY = 2048
END = bytes(4)
# Pieces of one partition, on average; a task holds a few short columns of them.
PIECES_PER_PARTITION = 8192
EXCHANGES = 3
# Words whose ids a worker remembers (about 200 bytes each); longer ones aren't.
WORDS_REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 64

# Texts (or 4 MiB of them) whose words are looked up at one time.
TEXTS_AT_ONCE = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", number long, bin long, offset long, fill long, bins long, bound long"


# The normalizer and pre-tokenizer of the default file. With these, a run of
# letters is a token of its own for the model, and so is a run of signs.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {
                "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
            },
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# Signs that may follow a word and split off; an apostrophe may not.
SIGNS = b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'
# Letters below this are the same in every version of Unicode, and single characters in NFC.
KNOWN_LETTERS = "\u0250"


def _byte_signs() -> dict[int, str]:
    """The visible sign that stands for each byte in a byte-level vocabulary: its own where
    Latin-1 prints one, else the next beyond Latin-1."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()


class WordIds:
    """Ids, as bytes, of words that white space separates.

    The tokenizer lowers case, drops white space and never joins words across it, so the
    ids of a text are those of its words. Words of well-known letters go straight to the
    tokenizer's model, and signs behind them split off; other new words are encoded many
    at a time, as one text, and told apart by their places in it.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.ids: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        described = json.loads(tokenizer_json)
        self.model = None
        if (described["normalizer"], described["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER):
            self.model = self.tokenizer.model

    def learn(self, words: set[bytes]) -> None:
        ids = self.ids
        if len(ids) + len(words) > WORDS_REMEMBERED:
            ids.clear()
        new = words.difference(ids)
        if self.model is not None:
            new = self._learn_plain(new)
        coded = sorted(new.difference(ids))
        texts = [w.decode() for w in coded]
        encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        all_ids = np.array(encoding.ids, "<u4").tobytes()
        begins = np.array([begin for begin, _ in encoding.offsets], np.int64)
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = (4 * np.searchsorted(begins, ends)).tolist()
        ids.update(zip(coded, map(all_ids.__getitem__, map(slice, [0, *cuts], cuts))))

    def _learn_plain(self, new: set[bytes]) -> set[bytes]:
        """Learn words of letters, with or without signs behind; the others are returned."""
        ids, tokenize = self.ids, self.model.tokenize
        others = set()
        for word in new:
            bare = word.rstrip(SIGNS)
            if bare not in ids:
                text = plain_letters(bare)
                if text is None:
                    others.add(word)
                    continue
                ids[bare] = array("I", [t.id for t in tokenize(text)]).tobytes()
            elif not bare or plain_letters(bare) is None:
                others.add(word)
                continue
            if len(bare) < len(word):
                tail = word[len(bare):]
                if tail not in ids:
                    coded = self.tokenizer.encode(tail.decode(), add_special_tokens=False)
                    ids[tail] = array("I", coded.ids).tobytes()
                ids[word] = ids[bare] + ids[tail]
        return others

    def forget_long(self, words: set[bytes]) -> None:
        for word in words:
            if len(word) > LONGEST_REMEMBERED:
                self.ids.pop(word, None)


def plain_letters(word: bytes) -> str | None:
    """A word as the tokenizer's model reads it, if it consists of well-known letters in
    lower case, too: there some become several characters."""
    if word.isascii():
        return word.lower().decode() if word.isalpha() else None
    text = word.decode().lower()
    if not text.isalpha() or max(text) >= KNOWN_LETTERS:
        return None
    return text.encode().decode("latin-1").translate(BYTE_SIGNS)


def _words(text: bytes | None) -> list[bytes]:
    """Words in lower case, but for texts that may hold a special token."""
    if not text:
        return []
    return text.split() if b"<|" in text else text.lower().split()


def _pieces_of(tokenizer_json: str, capacity: int):
    """Cuts documents into pieces."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(tokenizer_json)
        step = 4 * capacity
        for batch in gathered(batches, TEXTS_AT_ONCE):
            texts = [_words(text) for text in utf8(batch.column(1))]
            words = set().union(*texts)
            known.learn(words)
            columns: list[list] = [[], [], [], [], []]
            for doc, parts in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = b"".join(map(known.ids.__getitem__, parts)) + END
                for piece, start in enumerate(range(0, len(ids), step)):
                    part = ids[start : start + step]
                    row = (doc, piece, start // 4, len(part) // 4, zlib.crc32(part))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            known.forget_long(words)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return work


def cut_into_pieces(
    docs: DataFrame, tokenizer_file: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) per piece. The ids of a document are its
    text's by the tokenizer, without special tokens, and then id 0; a null text is empty.
    Only documents of more than ``capacity`` ids are cut. The tokenizer must drop white
    space, like the default ``word_bpe_49k.json``."""
    if tokenizer_file is None:
        import public_tokenizers

        tokenizer_file = public_tokenizers.path("word_bpe_49k.json")
    with open(tokenizer_file, encoding="utf-8") as f:
        work = _pieces_of(f.read(), capacity)
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. The longest first, each into the bin with the least
    room that suffices; bins with equal room are taken latest first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0  # rooms: bit r is set if a bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, opened
            opened += 1
        bins[i], offsets[i] = b, capacity - room
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins, offsets


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing undercuts: the largest bound of two families of
    dual-feasible functions, in whole numbers.

    The first counts pieces over capacity - t as whole bins, leaves out those under t and
    takes the others at their length, for every t up to half a bin. The second rounds
    multiples of the length down: floor((k + 1) x) / k, and x itself where (k + 1) x is
    whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    number, total = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    middle = total[capacity - t] - np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    bound = int((large + -(-middle // capacity)).max())
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * size, scaled // capacity * capacity)
        bound = max(bound, -(-int((count * value).sum()) // (k * capacity)))
    return bound


def _packer(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        opened = int(bins.max()) + 1
        fill = np.bincount(bins, lengths, minlength=opened).astype(np.int64)
        columns = {name: group[name] for name in ("doc_id", "piece", "start", "length")}
        return pa.table(
            columns
            | {
                "ids_crc32": group["ids_crc32"],
                "number": group["number"],
                "bin": (group["dealt"].to_numpy().astype(np.int64) << 32) | bins,
                "offset": offsets,
                "fill": fill[bins],
                "bins": np.full(len(bins), opened),
                "bound": np.full(len(bins), least_bins(lengths, capacity)),
            }
        )

    return pack


def _packed(pieces: DataFrame, round_no: int, capacity: int, size: int) -> DataFrame:
    """Deal ``pieces`` to partitions and pack each. Bin numbers hold the round, the
    partition and the bin."""
    parts = max(1, -(-pieces.count() // size))
    dealt = F.pmod(F.xxhash64("number", F.lit(round_no)), F.lit(parts))
    numbered = pieces.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "number",
        (dealt + F.lit(round_no << 24)).cast("int").alias("dealt"),
    )
    return written(numbered.groupBy("dealt").applyInArrow(_packer(capacity), PACKED), "packed")


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    pieces_per_partition: int = PIECES_PER_PARTITION,
    exchanges: int = EXCHANGES,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified) per piece.

    A sequence holds at most ``capacity`` tokens, without gaps; ``certified`` says that
    the piece's partition takes no more sequences than the bound. Repeated rows and null
    ids are packed like any others: pieces are dealt by their number, not by what they hold.
    Runs jobs.
    """
    numbered = pieces.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.monotonically_increasing_id().alias("number"),
    )
    pieces = written(numbered, "pieces")
    done = None
    current = _packed(pieces, 0, capacity, pieces_per_partition)
    for number in range(1, exchanges + 1):
        part = F.shiftright("bin", 32)
        emptiest = current.groupBy(part.alias("_p")).agg(
            F.min_by("bin", F.struct("fill", "bin")).alias("_bin")
        )
        current = current.join(
            emptiest.select(F.col("_bin").alias("bin"), F.lit(True).alias("_emptiest")),
            "bin", "left",
        )
        given = F.coalesce("_emptiest", F.lit(False)) | (F.col("bins") > F.col("bound"))
        given = given & (F.col("fill") < capacity)
        current = written(current.withColumn("_given", given).drop("_emptiest"), "packed")
        pool = current.filter("_given").drop("_given")
        before = pool.agg(F.count_distinct("bin")).first()[0]
        if before < 2:
            current = current.drop("_given")
            break
        # Twice as many pieces meet in each further round.
        again = _packed(pool, number, capacity, pieces_per_partition << number)
        after = again.agg(F.count_distinct("bin")).first()[0]
        current = current.drop("_given") if after >= before else current
        if after >= before:
            break
        kept = current.filter("NOT _given").drop("_given")
        done = kept if done is None else done.unionByName(kept)
        current = again
    result = current if done is None else done.unionByName(current.select(done.columns))
    return result.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"),
        "offset", (F.col("bins") <= F.col("bound")).alias("certified"),
    )
