"""Conversation repair against a search over all short strings of edits, and in parts against whole."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import connect, differences
from tillstream.llm import conversations, oracles, queries
from tillstream.llm.conversations import deletions, edited, joined, repair, step_of

SF = "/root/testdata/sf0.01"
WELL_FORMED = re.compile(r"(s?(ua)+)?")


def apply_by_hand(rows, audit):
    """(cost, roles' initials) of an audit, or None if it does not fit the rows; every choice of roles is tried."""
    results, rows = [], list(rows)

    def go(k, i, cost, out):
        if k == len(audit):
            if i == len(rows):
                results.append((cost, "".join(out)))
            return
        edit = audit[k]
        if edit == "I":
            for r in "ua":
                go(k + 1, i, cost + 5, [*out, r])
            return
        if i == len(rows):
            return
        initial, unfinished, gone = rows[i]
        extra = 5 if unfinished else 0
        if edit == "D":
            go(k + 1, i + 1, cost + 2, out)
        elif not gone and edit == "K":
            go(k + 1, i + 1, cost + extra, [*out, initial])
        elif not gone and edit == "R":
            for r in "ua":
                go(k + 1, i + 1, cost + 1 + extra, [*out, r])

    go(0, 0, 0, [])
    fitting = [c for c, out in results if WELL_FORMED.fullmatch(out)]
    return min(fitting, default=None)


def best_by_hand(rows):
    found = []
    for inserts in range(3):
        for letters in itertools.product("DKR", repeat=len(rows)):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
                audit = "".join("I" * places.count(k) + (letters[k] if k < len(rows) else "") for k in range(len(rows) + 1))
                cost = apply_by_hand(rows, audit)
                if cost is not None:
                    found.append((cost, audit))
    return min(found)


def steps_of(rows):
    return [deletions(1) if gone else step_of(initial, unfinished) for initial, unfinished, gone in rows]


ROW = st.tuples(st.sampled_from("suax"), st.booleans(), st.sampled_from([False, False, False, True]))


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=4))
def test_cheapest_of_all_edits(rows):
    assert repair(steps_of(rows)) == best_by_hand(rows)


@settings(max_examples=30, deadline=None)
@given(st.lists(ROW, max_size=200), st.integers(1, 70))
def test_blocks_change_nothing(rows, size):
    steps = steps_of(rows)
    whole = conversations.deduce(steps, 0, conversations.ACCEPTED)[-1]
    assert repair(steps) == whole
    parts = [joined(steps[k:k + size]) for k in range(0, len(steps), size)]
    assert repair(parts, inserts=False) == whole


def test_edited_turns():
    rows = [(0, "user", "a."), (3, "", ""), (0, "tool", "b.")]
    assert list(edited(rows, "KDDDR")) == [("user", "a.", "K"), ("assistant", "b.", "R")]
    assert list(edited([(0, "system", "s.")], "KII")) == [("system", "s.", "K"), ("user", "", "I"), ("assistant", "", "I")]


def facts_by_hand(rows):
    """The contract's columns of one conversation's rows after damage, in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        ended = text.rstrip(" \t\n\x0b\x0c\r")
        if not ended:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if ended[-1] not in ".!?" else "")
        if ended:
            seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = repair([
        deletions(1) if f in ("blank", "duplicate") else step_of(i, f == "truncated") for i, f in zip(initials, faults)
    ])
    kept = edited([(1, "", "") if f in ("blank", "duplicate") else (0, r, t) for (_, r, t), f in zip(rows, faults)], audit)
    lines = "\n".join(f"{r}:{t}" for r, t, _ in kept)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256(lines.encode()).hexdigest(),
    )


def damaged_by_hand(rows):
    out = {}
    for conv, turn, role, text in rows:
        found = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        found += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return {conv: facts_by_hand(found) for conv, found in out.items()}


def odd_conversations():
    rng = random.Random(3)
    texts = ["Yes.", "No!", "", " \n", None, "and then", "What? ", "x" * 5000 + ".", "…", "à la fin. "]
    roles = ["user", "assistant", "system", "tool", None, ""]
    rows = [
        (conv, turn, rng.choice(roles[:3] * 3 + roles), f"{turn}{rng.choice('.!?')}" if rng.random() < 0.6 else rng.choice(texts))
        for conv in [None, *range(60)] for turn in range(rng.randrange(1, 14))
    ]
    rows += [(100, t, "user", "same.") for t in range(40)] + [(101, t, "ua"[t % 2], f"{t}.") for t in range(130)]
    return rows + [(102, None, "user", "a."), (102, None, "user", "a."), (102, 7, "assistant", "b."), (103, None, None, None)]


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("longest", [10_000, 5, 0])
def test_conversations(spark, monkeypatch, longest):
    """Whole, and with long ones dealt over several tasks."""
    monkeypatch.setattr(conversations, "LONG", longest)
    rows = odd_conversations()
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, conv string")
    found = conversations.with_digest(
        conversations.repair_conversations(queries.damaged(table), present="present"), "repaired_sha256"
    ).collect()
    assert {r["conv"]: tuple(r[c] for c in COLUMNS) for r in found} == damaged_by_hand(rows)
    assert len(found) == len({r[0] for r in rows})


def test_equal_rows_of_one_turn(spark, monkeypatch):
    """A turn that fills a conversation is counted, not gathered."""
    rows = [(1, 1, "user", "Hm.")] * 500 + [(1, 2, "assistant", "So.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = conversations.repair_conversations(table).conversations.first()
    monkeypatch.setattr(conversations, "LONG", 10)
    found = conversations.repair_conversations(table)
    assert whole["audit"] == found.conversations.first()["audit"] == "K" + "D" * 499 + "K"
    assert whole["illegal"] == found.conversations.first()["illegal"] == 499
    assert [(r["role"], r["text"]) for r in found.turns.orderBy("place").collect()] == [("user", "Hm."), ("assistant", "So.")]


def test_no_conversations(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_conversations(table).conversations.count() == 0
    gone = spark.createDataFrame([(1, 1, "user", "a", False)], "conv_id long, turn long, role string, text string, present boolean")
    row = conversations.with_digest(conversations.repair_conversations(gone, present="present"), "d").first()
    assert (row["cost"], row["audit"], row["d"]) == (0, "", hashlib.sha256(b"").hexdigest())


def test_query_equals_sql(spark):
    rows, found = differences(spark, connect(SF), SF, queries.op13_conversation_repair, oracles.SQL["op13_conversation_repair"])
    assert rows == 100 and found == []
