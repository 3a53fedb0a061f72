"""Repair the structure of conversations: faults, the cheapest edits, the repaired text.

A conversation is in order if its roles' initials read ``(s?(ua)+)?``. What is left to do after
some rows is one of four states, so the cheapest edits are a shortest path through nodes (row,
state). Costs come first, from the last row to the first. The arcs that keep to these costs make a
graph in which every path is a cheapest one; its nodes are ranked by their least audits of one
letter, then of two, four and so on, by pairs of ranks, while each node's pointer to the end of
that audit is doubled. The ranks say which conversations share an audit, and the doubled
pointers read it.

Rows are dealt by ranges of conversation and turn, so a long conversation spreads over tasks. Most
conversations begin and end within a task's rows and are done there. The others are cut into
segments of a bounded number of rows, which are joined by scans: of 4x4 cost matrices from
the end, and of the states that the least paths lead to from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import mapped, written

SPACE = " \t\n\x0b\f\r"
ENDS = ".!?"

# Costs of the edits and of a truncated row that stays.
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
EDITS = b"DIKR"
# States: nothing yet, after the system's row, after a user's, after an assistant's. The first
# and the last may end a conversation.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FINAL = (START, ASSISTANT)
# What a row of each initial (other, s, u, a) leads to from each state; -1 can't be kept.
KEEP = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
# The role that a rerole or an insert gives in each state, and the state after it.
GIVEN = ("user", "user", "assistant", "user")
TURN = np.array([USER, USER, ASSISTANT, USER])
INITIALS = {"s": 1, "u": 2, "a": 3}
IN_ORDER = {(1, 2), (2, 3), (3, 2)}
# A row's code: its initial and its fault.
BLANK, TRUNCATED, DUPLICATE = 4, 8, 16

NEVER = 1 << 40
# Rows and bytes of a segment (a longer row is one of its own), rows and bytes that are solved at
# one time, places that a scan's group holds, nodes of paths that are read at one time.
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 1 << 19
SOLVED_ROWS, SOLVED_BYTES = 1 << 14, 1 << 24
FAN = 1024
PATH_CELLS = 1 << 20

FAULTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
REPORT = f"{FAULTS}, audit string, repaired_sha256 string, repaired string"
SEGMENT = (
    "part int, seq int, codes binary, keys array<binary>, roles array<string>, "
    "texts array<string>, turn_first long, turn_last long, turns long"
)


# --- cheapest costs and least audits of many segments at a time ---


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs (..., state, end) if rows may also be inserted here."""
    c = costs.copy()
    c[:, USER] = np.minimum(costs[:, USER], INSERT + costs[:, ASSISTANT])
    c[:, ASSISTANT] = np.minimum(costs[:, ASSISTANT], INSERT + costs[:, USER])
    for state in (START, SYSTEM):
        c[:, state] = np.minimum(costs[:, state], INSERT + c[:, USER])
    return c


def _ending() -> np.ndarray:
    """Costs per state where no row is left."""
    costs = np.full((1, STATES, 1), NEVER, np.int64)
    costs[:, list(FINAL)] = 0
    return _with_inserts(costs)[0, :, 0]


class Levels:
    """The places before, between and after the rows of several segments."""

    def __init__(self, codes: Sequence[bytes]):
        self.lengths = np.array([len(c) for c in codes], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]]).astype(np.int64)
        self.after = self.first + self.lengths
        self.count = int((self.lengths + 1).sum())
        # Codes by level; the level after the last row has none.
        self.codes = np.frombuffer(b"".join(bytes(c) + b"\0" for c in codes), np.uint8)

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Least costs (level, state, end) of what follows, given those after the last rows."""
        costs = np.empty((self.count, *ends.shape[1:]), np.int64)
        costs[self.after] = ends
        longest_first = np.argsort(-self.lengths, kind="stable")
        sorted_lengths = -self.lengths[longest_first]
        for back in range(1, int(self.lengths.max(initial=0)) + 1):
            active = longest_first[: np.searchsorted(sorted_lengths, -back, side="right")]
            here = self.after[active] - back
            costs[here] = _before_row(costs[here + 1], self.codes[here])
        return costs


def _before_row(after: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Costs before a row of each segment, from those after it."""
    initial, stays = codes & 3, (codes & (BLANK | DUPLICATE)) == 0
    extra = np.where(codes & TRUNCATED, CUT_OFF, 0)
    kept_to = KEEP[:, initial]
    costs = DELETE + after
    rows = np.arange(len(codes))
    for state in range(STATES):
        rerole = REROLE + extra[:, None] + after[:, TURN[state]]
        to = kept_to[state]
        keep = np.where((to >= 0)[:, None], extra[:, None] + after[rows, to], NEVER)
        best = np.where(stays[:, None], np.minimum(rerole, keep), NEVER)
        costs[:, state] = np.minimum(costs[:, state], best)
    return np.minimum(_with_inserts(costs), NEVER)


def least_paths(
    codes: Sequence[bytes], ends: np.ndarray, last: np.ndarray, entries: Sequence[int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For segments with costs ``ends`` (segment, state) after their rows, where ``last`` ones
    end there: (costs, states after, audits), each by (segment, entry state)."""
    levels = Levels(codes)
    costs = levels.costs(ends[:, :, None])[:, :, 0]
    level, state = np.divmod(np.arange(levels.count * STATES), STATES)
    code, cost = levels.codes[level], costs.ravel()
    has_row = np.ones(levels.count, bool)
    has_row[levels.after] = False
    may_insert = has_row.copy()
    may_insert[levels.after[last]] = True
    stays = has_row[level] & ((code & (BLANK | DUPLICATE)) == 0)
    extra = np.where(code & TRUNCATED, CUT_OFF, 0)
    kept_to = KEEP[state, code & 3]
    following = (level + 1) * STATES
    arcs = [  # by letter: allowed, target, cost
        (has_row[level], following + state, DELETE),
        (may_insert[level], level * STATES + TURN[state], INSERT),
        (stays & (kept_to >= 0), following + kept_to, extra),
        (stays, following + TURN[state], REROLE + extra),
    ]
    # Of the arcs that keep to the least cost, the one with the least letter: the letters of a
    # node's arcs differ, so one arc is left.
    own = np.arange(len(cost))
    rank, pointer = np.zeros(len(cost), np.int64), own.copy()
    for letter, (allowed, target, weight) in reversed(list(enumerate(arcs, 1))):
        target = np.where(allowed, target, own)
        best = allowed & (cost < NEVER) & (weight + cost[target] == cost)
        rank[best] = letter
        pointer[best] = target[best]
    letters = rank.astype(np.uint8)
    pointers = [pointer]
    while (letters[pointer] > 0).any():
        # Audits twice as long compare by the rank of their first half, then of their second.
        pair = rank * (rank.max() + 1) + rank[pointer]
        rank = np.unique(pair, return_inverse=True)[1]
        pointer = pointer[pointer]
        pointers.append(pointer)
    nodes = (levels.first[:, None] * STATES + np.array(entries)).ravel()
    _, one_of, which = np.unique(rank[nodes], return_index=True, return_inverse=True)
    audits = _read(nodes[one_of], letters, pointers)
    shape = (len(codes), len(entries))
    return (
        cost[nodes].reshape(shape),
        (pointer[nodes] % STATES).reshape(shape),
        audits[which].reshape(shape),
    )


def _read(starts: np.ndarray, letters: np.ndarray, pointers: list[np.ndarray]) -> np.ndarray:
    """The audits of the paths from these nodes, through doubled pointers: twice as many
    letters each time."""
    audits = np.empty(len(starts), object)
    of_letter = np.frombuffer(b" " + EDITS, np.uint8)
    at_once = max(1, PATH_CELLS >> len(pointers))
    # Paths of like lengths are read together, so short ones need few rounds.
    order = np.argsort([_rounds(s, letters, pointers) for s in starts], kind="stable")
    for k in range(0, len(starts), at_once):
        some = order[k : k + at_once]
        path = starts[some][:, None]
        for pointer in pointers:
            further = pointer[path]
            if not letters[further[:, 0]].any():
                path = np.concatenate([path, further], axis=1)
                break
            path = np.concatenate([path, further], axis=1)
        for s, text in zip(some, of_letter[letters[path]], strict=True):
            audits[s] = text.tobytes().rstrip(b" ")
    return audits


def _rounds(start: int, letters: np.ndarray, pointers: list[np.ndarray]) -> int:
    for k, pointer in enumerate(pointers):
        if not letters[pointer[start]]:
            return k
    return len(pointers)


def repaired_rows(
    state: int, audit: bytes, codes: bytes, roles: Sequence[str], texts: Sequence[str]
) -> Iterator[str]:
    """The rows that the edits leave, as ``role:text``."""
    row = 0
    for edit in audit:
        if edit == b"I"[0]:
            yield f"{GIVEN[state]}:"
            state = TURN[state]
            continue
        if edit == b"K"[0]:
            yield f"{roles[row]}:{texts[row]}"
            state = KEEP[state, codes[row] & 3]
        elif edit == b"R"[0]:
            yield f"{GIVEN[state]}:{texts[row]}"
            state = TURN[state]
        row += 1


# --- rows of a task to reports and open segments ---


class Segment:
    """Rows in a row of one conversation, after damage."""

    def __init__(self, conv):
        self.conv = conv
        self.codes, self.size = bytearray(), 0
        self.keys: list[bytes | None] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.seen: set[bytes] = set()
        self.first = self.last = None
        self.turns = 0

    def add(self, turn, role: str, text: str, mark: bytes, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        key = None if fault == BLANK else mark + role.encode()
        if key is not None and key in self.seen:
            fault = DUPLICATE
        self.seen.add(key)
        self.codes.append(INITIALS.get(role[:1], 0) | fault)
        self.keys.append(key)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text) + len(role)


def _faults(codes: bytes, before: int | None = None) -> list[int]:
    """Numbers of blank, duplicate, truncated rows and of pairs out of order."""
    initials = [c & 3 for c in codes] if before is None else [before, *(c & 3 for c in codes)]
    illegal = sum(1 for pair in zip(initials, initials[1:]) if pair not in IN_ORDER)
    kinds = [sum(1 for c in codes if c & kind) for kind in (BLANK, DUPLICATE, TRUNCATED)]
    return [*kinds, illegal]


def _report(segments: list[Segment], with_text: bool) -> list[tuple]:
    """Reports of whole conversations."""
    codes = [bytes(s.codes) for s in segments]
    ends = np.repeat(_ending()[None], len(codes), axis=0)
    costs, _, audits = least_paths(codes, ends, np.ones(len(codes), bool), [START])
    rows = []
    for s, code, cost, audit in zip(segments, codes, costs[:, 0], audits[:, 0], strict=True):
        gaps = 0 if s.first is None else s.last - s.first + 1 - s.turns
        text = "\n".join(repaired_rows(START, audit, code, s.roles, s.texts))
        digest = hashlib.sha256(text.encode()).hexdigest()
        rows.append((
            s.conv, gaps, *_faults(code), int(cost), audit.decode(), digest,
            text if with_text else None,
        ))
    return rows


def _table(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, types, strict=True)], schema=types
    )


REPORT_TYPES = [
    *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()), ("repaired_sha256", pa.string()), ("repaired", pa.string()),
]
SEGMENT_TYPES = [
    ("part", pa.int32()), ("seq", pa.int32()), ("codes", pa.binary()),
    ("keys", pa.list_(pa.binary())), ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())), ("turn_first", pa.int64()), ("turn_last", pa.int64()),
    ("turns", pa.int64()),
]


def _read_rows(with_text: bool, segment_rows: int):
    """Reports of the conversations that begin and end within a task, segments of the others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        types, segment, whole = None, None, False
        done: list[Segment] = []
        rows = size = seq = 0

        def opened(s: Segment) -> pa.RecordBatch:
            nonlocal seq
            seq += 1
            own = (
                part, seq, bytes(s.codes), s.keys, s.roles, s.texts, s.first, s.last, s.turns,
            )
            return _table([(s.conv, *[None] * len(REPORT_TYPES), *own)], types)

        def reported() -> pa.RecordBatch:
            empty = [None] * len(SEGMENT_TYPES)
            return _table([(*r, *empty) for r in _report(done, with_text)], types)

        for batch in batches:
            if types is None:
                types = pa.schema([
                    batch.schema.field("conv_id").with_nullable(True), *REPORT_TYPES,
                    *SEGMENT_TYPES,
                ])
            columns = [batch.column(n).to_pylist() for n in batch.schema.names]
            for conv, turn, role, text, mark, fault, copies in zip(*columns, strict=True):
                if segment is None or conv != segment.conv:
                    if segment is not None and whole:
                        done.append(segment)
                        rows, size = rows + len(segment.codes), size + segment.size
                    elif segment is not None:
                        yield opened(segment)
                    # The first conversation may have begun in another task.
                    whole = segment is not None
                    segment = Segment(conv)
                    if max(rows, len(done)) >= SOLVED_ROWS or size >= SOLVED_BYTES:
                        yield reported()
                        done, rows, size = [], 0, 0
                for _ in range(copies):
                    if len(segment.codes) >= segment_rows or segment.size >= SEGMENT_BYTES:
                        yield opened(segment)
                        segment, whole = Segment(conv), False
                    segment.add(turn, role, text, mark, fault)
        if done:
            yield reported()
        # The last one may go on in another task.
        if segment is not None:
            yield opened(segment)

    return work


# --- segments that have to be joined ---


def _scanned(
    rows: DataFrame, combine: Callable[[np.ndarray, np.ndarray], np.ndarray], neutral: Sequence[int]
) -> DataFrame:
    """(conv, place, before): for (conv, place, value) with places from 0, the combination of all
    earlier values. A group never holds more than ``FAN`` rows: beyond that, groups are
    combined first, and their own scan gives each group its start."""
    most = rows.agg(F.max("place")).first()[0]
    group = F.floor(F.col("place") / FAN)
    start = F.array(*(F.lit(int(n)).cast("long") for n in neutral))
    if most is None or most < FAN:
        grouped = rows.withColumns({"group": F.lit(0).cast("long"), "start": start})
    else:

        def folded(t: pa.Table) -> pa.Table:
            total = np.array(neutral)
            for value in t.sort_by("place").column("value").to_pylist():
                total = combine(total, np.array(value))
            return pa.table({
                "conv": t.column("conv")[:1], "place": t.column("group")[:1],
                "value": pa.array([total.tolist()], pa.list_(pa.int64())),
            })

        sums = written(
            rows.withColumn("group", group).groupBy("conv", "group")
            .applyInArrow(folded, "conv string, place long, value array<long>"),
            "scan",
        )
        starts = _scanned(sums, combine, neutral).withColumnsRenamed(
            {"place": "group", "before": "start"}
        )
        grouped = rows.withColumn("group", group).join(starts, ["conv", "group"])

    def within(t: pa.Table) -> pa.Table:
        t = t.sort_by("place")
        total, before = np.array(t.column("start")[0].as_py()), []
        for value in t.column("value").to_pylist():
            before.append(total.tolist())
            total = combine(total, np.array(value))
        return pa.table({
            "conv": t.column("conv"), "place": t.column("place"),
            "before": pa.array(before, pa.list_(pa.int64())),
        })

    return grouped.groupBy("conv", "group").applyInArrow(
        within, "conv string, place long, before array<long>"
    )


def _marked(codes: bytes, again: Iterable[int] | None) -> bytes:
    """Codes with the duplicates of rows in earlier segments."""
    codes = bytearray(codes)
    for row in again or ():
        codes[row] = codes[row] & 3 | DUPLICATE
    return bytes(codes)


def _later_first(later: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Cost matrices of one segment followed by those behind it."""
    a, b = own.reshape(STATES, STATES), later.reshape(STATES, STATES)
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), NEVER).ravel()


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    single = np.where(np.eye(STATES, dtype=bool), 0, NEVER)
    for b in batches:
        codes = [
            _marked(c, a)
            for c, a in zip(b.column("codes").to_pylist(), b.column("again").to_pylist(), strict=True)
        ]
        levels = Levels(codes)
        costs = levels.costs(np.repeat(single[None], len(codes), axis=0))[levels.first]
        yield pa.RecordBatch.from_arrays(
            [
                b.column("conv"), b.column("place"),
                pa.array(costs.reshape(len(codes), -1).tolist(), pa.list_(pa.int64())),
            ],
            ["conv", "place", "value"],
        )


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns = (b.column(n).to_pylist() for n in ("codes", "again", "before", "after"))
        codes, ends, last = [], [], []
        for code, again, later, after in zip(*columns, strict=True):
            codes.append(_marked(code, again))
            matrix = np.array(later).reshape(STATES, STATES)
            last.append(after == 0)
            ends.append(np.minimum((matrix + _ending()).min(axis=1), NEVER))
        found = least_paths(codes, np.array(ends), np.array(last), range(STATES))
        costs, states, audits = found
        yield pa.RecordBatch.from_arrays(
            [
                b.column("conv"), b.column("place"), b.column("part"), b.column("seq"),
                pa.array(codes, pa.binary()),
                pa.array(states.tolist(), pa.list_(pa.int64())),
                pa.array([[a.decode() for a in row] for row in audits], pa.list_(pa.string())),
                pa.array(costs[:, START], pa.int64()),
            ],
            ["conv", "place", "part", "seq", "codes", "value", "audits", "cost"],
        )


def _assembled(with_text: bool):
    """Reports from the segments of each conversation, which come in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, key, report = None, None, None

        def finished() -> pa.RecordBatch:
            conv, first, last, turns, faults, cost, audits, digest, texts, _, _ = report
            gaps = 0 if first is None else last - first + 1 - turns
            text = "\n".join(texts) if with_text else None
            row = (conv, gaps, *faults, cost, "".join(audits), digest.hexdigest(), text)
            return _table([row], types)

        for batch in batches:
            if types is None:
                conv = batch.schema.field("conv_id").with_nullable(True)
                types = pa.schema([conv, *REPORT_TYPES])
            for r in batch.to_pylist():
                if r["conv"] != key:
                    if report:
                        yield finished()
                    key = r["conv"]
                    report = [
                        r["conv_id"], None, None, 0, [0] * 4, r["cost"], [], hashlib.sha256(), [],
                        None, False,
                    ]
                if r["turn_first"] is not None:
                    report[3] += r["turns"] - (r["turn_first"] == report[2])
                    report[1] = r["turn_first"] if report[1] is None else report[1]
                    report[2] = r["turn_last"]
                report[4] = [
                    a + b for a, b in zip(report[4], _faults(r["codes"], report[9]), strict=True)
                ]
                report[9] = r["codes"][-1] & 3 if r["codes"] else report[9]
                report[6].append(r["audit"])
                rows = repaired_rows(
                    r["state"], r["audit"].encode(), r["codes"], r["roles"], r["texts"]
                )
                for text in rows:
                    report[7].update(("\n" + text if report[10] else text).encode())
                    report[10] = True
                    if with_text:
                        report[8].append(text)
        if report:
            yield finished()

    return work


def _joined(segments: DataFrame, conv_type: str, with_text: bool) -> DataFrame:
    """Reports of the conversations in ``segments``. Only the last step reads texts."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    in_order = Window.partitionBy("conv").orderBy("part", "seq")
    # One short row per segment.
    places = written(
        segments.select(conv.alias("conv"), "part", "seq", "codes").withColumns({
            "place": (F.row_number().over(in_order) - 1).cast("long"),
            "after": F.count("*").over(Window.partitionBy("conv")) - F.row_number().over(in_order),
        }),
        "places",
    )
    keys = segments.select(
        conv.alias("conv"), F.struct("part", "seq").alias("at"), F.posexplode("keys").alias("row", "key")
    ).filter("key IS NOT NULL")
    firsts = keys.groupBy("conv", "key").agg(
        F.min("at").alias("first"), F.max("at").alias("other")
    ).filter("first <> other")
    again = (
        keys.join(firsts.select("conv", "key", "first"), ["conv", "key"])
        .filter("at <> first")
        .groupBy("at.part", "at.seq")
        .agg(F.collect_list("row").alias("again"))
    )
    places = written(places.join(again, ["part", "seq"], "left"), "places")
    matrices = written(
        mapped(places.select("conv", F.col("after").alias("place"), "codes", "again"), _matrices,
               "conv string, place long, value array<long>"),
        "matrices",
    )
    single = np.where(np.eye(STATES, dtype=bool), 0, NEVER).ravel()
    ends = _scanned(matrices, _later_first, single).withColumnRenamed("place", "after")
    solved = written(
        mapped(
            places.join(ends, ["conv", "after"])
            .select("conv", "place", "part", "seq", "codes", "again", "before", "after"),
            _solved,
            "conv string, place long, part int, seq int, codes binary, value array<long>, "
            "audits array<string>, cost long",
        ),
        "solved",
    )
    # States after the earlier segments, for each state that the first might begin with.
    entries = _scanned(
        solved.select("conv", "place", "value"), lambda a, b: b[a], range(STATES)
    ).select("conv", "place", F.col("before")[START].cast("int").alias("state"))
    chosen = solved.join(entries, ["conv", "place"]).select(
        "conv", "place", "part", "seq", "codes", "cost", "state",
        F.element_at("audits", F.col("state") + 1).alias("audit"),
    )
    texts = segments.select(
        "conv_id", "part", "seq", "roles", "texts", "turn_first", "turn_last", "turns"
    )
    return (
        texts.join(chosen, ["part", "seq"])
        .repartition("conv")
        .sortWithinPartitions("conv", "place")
        .mapInArrow(_assembled(with_text), f"conv_id {conv_type}, {REPORT}")
    )


# --- the operator ---


def _fault(text: Column) -> Column:
    said = F.rtrim(text, F.lit(SPACE))
    return (
        F.when(said == "", BLANK)
        .when(~F.right(said, F.lit(1)).isin(*ENDS), TRUNCATED)
        .otherwise(0)
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with faults to be repaired, chosen by a hash of
    conversation and turn: no copy, no text, no signs that end a sentence, two copies, the
    user's role. Nulls read as a space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))), F.lit(20))
    text = (
        F.when(kind == 1, "")
        .when(kind == 2, F.translate(text_of("text"), ENDS, ""))
        .otherwise(text_of("text"))
    )
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(text_of("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair(
    conversations: DataFrame, with_text: bool = False, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per
    conversation of rows (conv_id, turn, role, text), with ``with_text`` also ``repaired``, its
    rows as ``role:text`` lines. A row stands for as many rows as ``copies`` says, if there is
    such a column; a conversation without any has zeros, no audit and the empty text.

    Rows are taken by turn, nulls first, and of equal turns by role and then by the SHA-256 of
    the text; so repeated rows are neighbours. A null role or text counts as a space. A null
    conv_id is a conversation of its own. A role whose first letter is none of s, u and a
    can't be kept. Texts are read whole; a long conversation is worked on by many tasks, but one
    task reads its segments in turn for the digest, holding one segment and the audit. An empty
    table gives no rows; other columns are not read. Runs jobs.
    """
    text_of = lambda c: F.coalesce(F.col(c), F.lit(" "))
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        text_of("role").alias("role"),
        text_of("text").alias("text"),
        F.unhex(F.sha2(text_of("text"), 256)).alias("mark"),
        _fault(text_of("text")).alias("fault"),
        F.coalesce(copies, F.lit(1)).cast("int").alias("copies"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "mark"]
    # Equal rows may be in any order, so a random number lets them spread over tasks.
    met = (
        rows.withColumn("_any", F.rand(0)).repartitionByRange(*order, "_any")
        .drop("_any").sortWithinPartitions(*order)
    )
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    found = written(
        mapped(met, _read_rows(with_text, segment_rows), f"conv_id {conv_type}, {REPORT}, {SEGMENT}"),
        "conversations",
    )
    report = ["conv_id", *(n for n, _ in REPORT_TYPES[: None if with_text else -1])]
    whole = found.filter("part IS NULL").select(*report)
    open_ones = found.filter("part IS NOT NULL").select(
        "conv_id", *(n for n, _ in SEGMENT_TYPES)
    )
    return whole.unionByName(_joined(open_ones, conv_type, with_text).select(*report))


def oracle() -> str:
    """The same rows for damaged conversations in SQL: cheapest edits from the last row to the
    first, each state with the least (cost, audit) and its repaired rows."""
    blank = "[\\x20\\x09-\\x0D]"

    def best(*choices: str) -> str:
        return f"list_sort([{', '.join(choices)}])[1]"

    def edit(letter: str, cost: str, piece: str, after: str) -> str:
        return (
            f"{{'c': {cost} + {after}.c, 'a': '{letter}' || {after}.a, "
            f"'t': {piece} || {after}.t}}"
        )

    given = [f"[{role!r} || ':']" for role in GIVEN]

    def with_inserts(names: list[str]) -> list[str]:
        """Insert at most two rows, which reaches every state that inserts can improve."""
        once = [
            best(n, edit("I", str(INSERT), given[q], names[TURN[q]])) for q, n in enumerate(names)
        ]
        return [
            best(once[q], edit("I", str(INSERT), given[q], once[TURN[q]]))
            for q in range(STATES)
        ]

    never = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"
    empty = "{'c': 0, 'a': '', 't': []::VARCHAR[]}"
    at_end = with_inserts([empty if q in FINAL else never for q in range(STATES)])
    steps = []
    for q in range(STATES):
        after = [f"s{k}" for k in range(STATES)]
        choices = [edit("D", str(DELETE), "[]::VARCHAR[]", after[q])]
        stays = "r.fault NOT IN ('blank', 'duplicate')"
        extra = f"(CASE WHEN r.fault = 'truncated' THEN {CUT_OFF} ELSE 0 END)"
        for initial, number in INITIALS.items():
            if KEEP[q, number] >= 0:
                keep = edit("K", extra, "[r.role || ':' || r.text]", after[KEEP[q, number]])
                choices.append(
                    f"CASE WHEN {stays} AND r.initial = '{initial}' THEN {keep} ELSE {never} END"
                )
        rerole = edit(
            "R", f"{REROLE} + {extra}", f"[{GIVEN[q]!r} || ':' || r.text]", after[TURN[q]]
        )
        choices.append(f"CASE WHEN {stays} THEN {rerole} ELSE {never} END")
        steps.append(f"{best(*choices)} AS b{q}")
    inserted = with_inserts([f"b{q}" for q in range(STATES)])
    state_list = ", ".join(f"{e} AS s{q}" for q, e in enumerate(inserted))
    end_list = ", ".join(f"{e} AS s{q}" for q, e in enumerate(at_end))
    crc = """list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(
        regexp_extract_all(hex(encode(name)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"""
    return f"""
WITH RECURSIVE n AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), k AS (SELECT *, xor({crc}, 4294967295) % 20 AS kind FROM n),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM k, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
), p AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos
  FROM d
), f AS (
  SELECT *, left(role, 1) AS initial, CASE
    WHEN regexp_full_match(text, '{blank}*') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(regexp_replace(text, '{blank}+$', ''), 1) NOT IN ('.', '!', '?') THEN 'truncated'
    ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM p
), t AS (
  SELECT conv_id, max(pos) AS size,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
), v AS (
  SELECT conv_id, size AS pos, {end_list} FROM t
  UNION ALL
  SELECT conv_id, pos, {state_list} FROM (
    SELECT v.conv_id, v.pos - 1 AS pos, {', '.join(steps)}
    FROM v JOIN f r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.pos = v.pos
  )
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit,
  sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM o.conv_id AND v.pos = 0
"""
