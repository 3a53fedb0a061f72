"""Repaired conversations against brute force, in whole and cut into segments."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import pairwise

import pytest

from orderlens.llm import conversations
from orderlens.llm.conversations import damaged, repair

ROW = "conv_id long, turn long, role string, text string, part int, audit string, place long"
NEXT = {
    ("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"
}


def after_damage(rows):
    kept = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    order = lambda r: (r[0] is not None, r[0], r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest())
    return {c: sorted(rs, key=lambda r: (order(r)[0], r[0] or 0, *order(r)[2:])) for c, rs in kept.items()}


def brute(rows):
    """One row per conversation, by trying all edits from each place and state."""
    faults, seen = [], set()
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = (
            "blank" if not said else "duplicate" if (role, text) in seen
            else "truncated" if said[-1] not in ".!?" else ""
        )
        faults.append(fault)
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserts):
        """(cost, audit, rows) of what is left, with at most so many inserts in a row."""
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            c, a, t = best(i + 1, state, 3)
            found.append((c + 4, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                for cost, letter, new in ((0, "K", role), (3, "R", "user"), (3, "R", "assistant")):
                    to = NEXT.get((state, new[:1]))
                    if to:
                        c, a, t = best(i + 1, to, 3)
                        found.append((c + cost + extra, letter + a, (f"{new}:{text}", *t)))
        for new in ("user", "assistant") if inserts else ():
            to = NEXT.get((state, new[0]))
            if to:
                c, a, t = best(i, to, inserts - 1)
                found.append((c + 3, "I" + a, (f"{new}:", *t)))
        return min(found, default=(10**9, "", ()))

    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, texts = best(0, "", 3)
    repaired = "\n".join(texts)
    assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in texts))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in pairwise(initials)),
        cost, audit, hashlib.sha256(repaired.encode()).hexdigest(), repaired,
    )


def check(frame, rows, **how):
    found = repair(damaged(frame), with_text=True, **how).collect()
    expected = after_damage(rows)
    assert sorted((r["conv_id"] is None, r["conv_id"]) for r in found) == sorted(
        (c is None, c) for c in expected
    )
    for r in found:
        assert tuple(r)[1:] == brute(expected[r["conv_id"]]), r["conv_id"]


def talk(seed, convs, turns):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Cut", "", "  ", "Why?\n", "Yes", "x. ", "é日.", "...", None, "\x0b", "a "]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, turns)):
            text = rng.choice(texts)
            if rng.random() < 0.6:
                text = f"{rng.randint(0, 10**6)}."
            rows.append((
                conv, rng.choice([turn, turn, turn, turn + 2, None]), rng.choice(roles), text, 1, "x", 2
            ))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = talk(seed, 150, 9)
    rows += [(None, *r[1:]) for r in rows[:12]]
    check(spark.createDataFrame(rows, ROW).repartition(4), rows)


@pytest.mark.parametrize("fan", [1024, 4])
def test_segments_are_joined(spark, monkeypatch, fan):
    """Conversations over many segments and tasks, and scans of several levels."""
    monkeypatch.setattr(conversations, "FAN", fan)
    rows = talk(3, 6, 150) + talk(4, 20, 4)[:30]
    rows += [(None, t, "user", f"{t}.", 1, "x", 1) for t in range(40)]
    check(spark.createDataFrame(rows, ROW).repartition(4), rows, segment_rows=7)


def test_one_conversation_of_equal_rows(spark):
    rows = [(5, None, "user", "Same.", 1, "x", 1)] * 60
    rows += [(5, 3, "assistant", "Fine.", 1, "x", 1)]
    check(spark.createDataFrame(rows, ROW), rows, segment_rows=8)


def test_no_rows_and_no_rows_left(spark):
    empty = spark.createDataFrame([], ROW)
    assert repair(damaged(empty)).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hello.", 1, "x", 1)]
    found = repair(damaged(spark.createDataFrame(rows, ROW))).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_long_texts_and_plain_rows(spark):
    """Texts over a segment's bytes, and rows that nobody damaged."""
    text = "word " * 300_000 + "end."
    rows = [(7, t, ("user", "assistant")[t % 2], f"{t} {text}") for t in range(4)]
    found = repair(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    repaired = "\n".join(f"{r}:{t}" for _, _, r, t in rows)
    assert [tuple(r) for r in found.collect()] == [
        (7, 0, 0, 0, 0, 0, 0, "KKKK", hashlib.sha256(repaired.encode()).hexdigest())
    ]
