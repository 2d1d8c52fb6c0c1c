"""Repair of a conversation's structure: the cheapest edits that make it alternate, by Knuth's agenda.

A conversation is well formed if the first letters of its roles read `(s?(ua)+)?`: perhaps a system turn, then pairs of user and
assistant. Rows are taken by turn (null first; rows of one turn by role, then by text's first characters and hash). A
row is faulty if it is blank, or else repeats an earlier role and text, or else ends without a stop. The edits are

    D  delete        2     K  keep     0 (5 if it ends without a stop)
    I  insert        5     R  new role 1 (likewise 5 more)

and blank or repeated rows must be deleted. The repair is the cheapest, and of equal ones the one whose string of edits is
least in ASCII order.

Items of the deduction are [rows edited so far, what the roles read so far], and a deduction extends an item by one weighted
edit; its value is the pair (cost, audit). Appending an edit never makes a pair smaller, and keeps the order of two values of one
item (equal costs mean equally many inserts, so neither audit begins the other), which is what Knuth's algorithm asks of
its functions. Items are popped from the agenda by value until the goal is. Long stretches are first
deduced from every state to every state in blocks, and an agenda of the same kind runs over blocks.

Conversations are dealt by their id. One with more than `LONG` rows or `LONG_BYTES` of text is not gathered: equal rows are
counted first, rows are dealt by range, so that a conversation goes through many tasks, each task deduces its part from every
state, and the parts are joined. The task that joins them holds edits only, 16 letters a row, and no text.

Null roles and texts count as one space. A null id is an id. Rows of `present` false only name their conversation: it is
returned even if it has no other. Without rows there is nothing to repair: zeros, and an empty audit. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.rows import KEY, hash_pair, only_keys, stored

DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
SPACES = " \t\n\x0b\x0c\r"
STOPS = [".", "!", "?"]
LEGAL = {"su", "ua", "au"}
LONG = 10_000
LONG_BYTES = 64 << 20
#: Steps that one agenda runs over where a stretch is deduced from every state.
BLOCK = 32
PREFIX = 32

# What the roles read so far: nothing, a system turn, an open pair, a closed pair.
NOTHING, SYSTEM, OPEN, CLOSED = STATES = range(4)
ACCEPTED = (NOTHING, CLOSED)
KEEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): OPEN, (SYSTEM, "u"): OPEN, (OPEN, "a"): CLOSED, (CLOSED, "u"): OPEN}
NEW_TURN = {NOTHING: OPEN, SYSTEM: OPEN, OPEN: CLOSED, CLOSED: OPEN}

Value = tuple[int, str]
Step = dict[int, list[tuple[int, str, int]]]


def step_of(initial: str, unfinished: bool) -> Step:
    """The edits of a row that may stay, by the state before it."""
    extra = UNFINISHED if unfinished else 0
    found: Step = {}
    for q in STATES:
        found[q] = [(DELETE, "D", q), (REROLE + extra, "R", NEW_TURN[q])]
        if (q, initial) in KEEPS:
            found[q].append((extra, "K", KEEPS[q, initial]))
    return found


def deletions(times: int) -> Step:
    """The only edit of rows that must go."""
    return {q: [(DELETE * times, "D" * times, q)] for q in STATES}


def deduce(steps: list[Step], entry: int, goals: Iterable[int] | None = None, inserts: bool = True) -> dict[int, Value]:
    """Knuth's agenda from [0, entry]: the values of the last items by state; with `goals`, only that of the goal, under -1."""
    last, final = len(steps), {}
    agenda, done = [(0, "", 0, entry)], set()
    while agenda:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == last:
            if goals is None:
                final[q] = (cost, audit)
            elif q == -1:
                return {-1: (cost, audit)}
            elif q in goals:
                heapq.heappush(agenda, (cost, audit, i, -1))
        if q < 0:
            continue
        if inserts and (i, NEW_TURN[q]) not in done:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, NEW_TURN[q]))
        if i < last:
            for weight, letters, to in steps[i].get(q, ()):
                if (i + 1, to) not in done:
                    heapq.heappush(agenda, (cost + weight, audit + letters, i + 1, to))
    return final


def joined(steps: list[Step], inserts: bool = True) -> Step:
    """A stretch as one step: the lightest edits from every state to every state."""
    if len(steps) > BLOCK:
        steps = [joined(steps[k:k + BLOCK], inserts) for k in range(0, len(steps), BLOCK)]
        return joined(steps, False)
    return {q: [(c, a, to) for to, (c, a) in deduce(steps, q, inserts=inserts).items()] for q in STATES}


def repair(steps: list[Step], inserts: bool = True) -> Value:
    """Cost and audit of the cheapest repair."""
    while len(steps) > BLOCK:
        steps, inserts = [joined(steps[k:k + BLOCK], inserts) for k in range(0, len(steps), BLOCK)], False
    return deduce(steps, NOTHING, ACCEPTED, inserts)[-1]


@dataclass
class Stretch:
    """Rows of one conversation in order, or a part of them."""

    rows: list[tuple[int, str, str]] = field(default_factory=list)  # (deletions due, role, text) of each step
    steps: list[Step] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTS, 0))
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None

    def add(self, turn: int | None, role: str, text: str | None, times: int, blank: bool, unfinished: bool, fresh: bool) -> None:
        initial, counts = role[:1], self.counts
        if self.last is not None:
            counts["illegal"] += self.last + initial not in LEGAL
        counts["illegal"] += times - 1
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            counts["turns"] += 1
        gone = times if blank or not fresh else times - 1
        if blank:
            counts["blank"] += times
        else:
            counts["duplicate"] += gone
            if fresh:
                counts["truncated"] += unfinished
                self.rows.append((0, role, text))
                self.steps.append(step_of(initial, unfinished))
        if gone and self.rows and self.rows[-1][0]:
            gone += self.rows.pop()[0]
            self.steps.pop()
        if gone:
            self.rows.append((gone, "", ""))
            self.steps.append(deletions(gone))


COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")


def edited(rows: Iterable[tuple[int, str, str]], audit: str, place: int = 0, odd: bool | None = None) -> Iterator[tuple[str, str, str]]:
    """(role, text, edit) of the turns that an audit leaves; `place` is that of the first, `odd` says that a system turn leads."""
    if odd is None:
        odd = (len(audit) - audit.count("D")) % 2 == 1
    rows, due = iter(rows), 0
    for edit in audit:
        role = text = ""
        if edit != "I":
            if due:
                due -= 1
            else:
                gone, role, text = next(rows)
                due = max(gone - 1, 0)
        if edit == "D":
            continue
        if edit != "K":
            role = "user" if (place - odd) % 2 == 0 else "assistant"
        yield role, text, edit
        place += 1


FACTS = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("cost", "long"), ("audit", "string")]
TURN = "struct<role string, text string, edit string>"
PART_ARROW = pa.struct([
    *[(c, pa.int64()) for c in (*COUNTS, "low", "high", "eaten")], ("first", pa.string()), ("last", pa.string()),
    ("cells", pa.list_(pa.struct([("q", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
PART = (
    "struct<turns long, blank long, duplicate long, truncated long, illegal long, low long, high long, eaten long, "
    "first string, last string, cells array<struct<q int, to int, cost long, audit string>>>"
)
ROW_ARROW = pa.struct([("gone", pa.int64()), ("role", pa.string()), ("text", pa.string())])
TURN_ARROW = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))
OUT_FACTS = ", ".join(f"{name} {kind}" for name, kind in FACTS)


def _facts(counts: dict[str, int], low: int | None, high: int | None, value: Value) -> dict:
    gaps = 0 if low is None else high - low + 1 - counts["turns"]
    return {"gaps": gaps, **{c: counts[c] for c in COUNTS[1:]}, "cost": value[0], "audit": value[1]}


def _whole(conv, stretch: Stretch) -> dict:
    value = repair(stretch.steps)
    turns = [dict(zip(("role", "text", "edit"), t)) for t in edited(stretch.rows, value[1])]
    return {"conv": conv, **_facts(stretch.counts, stretch.low, stretch.high, value), "repaired": turns}


def _part(conv, stretch: Stretch, segment: int) -> dict:
    """A part of a conversation that goes on in other tasks."""
    cells = [{"q": q, "to": to, "cost": c, "audit": a} for q, edges in joined(stretch.steps).items() for c, a, to in edges]
    ends = {"low": stretch.low, "high": stretch.high, "first": stretch.first, "last": stretch.last}
    eaten = sum(max(gone, 1) for gone, _, _ in stretch.rows)
    return {"conv": conv, "segment": segment, "part": {**stretch.counts, **ends, "eaten": eaten, "cells": cells}}


def _batch(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    fields = [("conv", kind), *[(n, pa.int64() if k == "long" else pa.string()) for n, k in FACTS]]
    fields += [("repaired", TURN_ARROW), ("segment", pa.int64()), ("part", PART_ARROW), ("place", pa.int64()), ("row", ROW_ARROW)]
    return pa.RecordBatch.from_pydict({n: pa.array([r.get(n) for r in rows], t) for n, t in fields})


def _stretches(batches: Iterator[pa.RecordBatch], marked: bool) -> Iterator[tuple[object, pa.DataType, Stretch]]:
    """Conversations in the order of sorted rows. First rows of a role and text are marked, or else remembered."""
    now, stretch, kind, seen, mark = None, None, None, set(), None
    for batch in batches:
        kind = batch.schema.field("conv").type
        columns = [batch[c].to_pylist() for c in ("conv", "turn", "role", "text", "times", "blank", "unfinished", "present", "mark", *KEY)]
        for conv, turn, role, text, times, blank, unfinished, present, is_mark, a, b in zip(*columns):
            if stretch is None or conv != now:
                if stretch is not None:
                    yield now, kind, stretch
                now, stretch, seen, mark = conv, Stretch(), set(), None
            if is_mark:
                mark = (turn, a, b)
            elif present:
                fresh = mark == (turn, a, b) if marked else (a, b) not in seen
                if not marked and not blank:
                    seen.add((a, b))
                stretch.add(turn, role, text, times, blank, unfinished, fresh)
    if stretch is not None:
        yield now, kind, stretch


def _repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for conv, kind, stretch in _stretches(batches, marked=False):
        out.append(_whole(conv, stretch))
        size += len(stretch.rows)
        if size > 1000:
            yield _batch(out, kind)
            out, size = [], 0
    if out:
        yield _batch(out, kind)


def _repair_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of a task may go on in others; those between are whole."""
    task, found = TaskContext.get().partitionId(), _stretches(batches, marked=True)

    def part(conv, kind: pa.DataType, stretch: Stretch, end: int) -> Iterator[pa.RecordBatch]:
        segment = 2 * task + end
        yield _batch([_part(conv, stretch, segment)], kind)
        for k in range(0, len(stretch.rows), 1000):
            yield _batch([
                {"conv": conv, "segment": segment, "place": k + j, "row": {"gone": gone, "role": role, "text": text}}
                for j, (gone, role, text) in enumerate(stretch.rows[k:k + 1000])
            ], kind)

    before = next(found, None)
    if before is not None:
        yield from part(*before, 0)
    before = None
    for here in found:
        if before is not None:
            yield _batch([_whole(before[0], before[2])], before[1])
        before = here
    if before is not None:
        yield from part(*before, 1)


def _join_parts(table: pa.Table) -> pa.Table:
    """One conversation from its parts: its facts, and for each part its edits and the place of its first turn."""
    parts = table.sort_by("segment").to_pylist()
    counts, low, high, last, steps = dict.fromkeys(COUNTS, 0), None, None, None, []
    for p in (row["part"] for row in parts):
        for c in COUNTS:
            counts[c] += p[c]
        if last is not None and p["first"] is not None:
            counts["illegal"] += last + p["first"] not in LEGAL
        if p["low"] is not None:
            counts["turns"] -= p["low"] == high
            low, high = p["low"] if low is None else low, p["high"]
        last = last if p["last"] is None else p["last"]
        step: Step = {q: [] for q in STATES}
        for cell in p["cells"]:
            step[cell["q"]].append((cell["cost"], cell["audit"], cell["to"]))
        steps.append(step)
    cost, audit = repair(steps, inserts=False)
    letters = np.frombuffer(audit.encode(), np.uint8)
    eats = np.flatnonzero(letters != ord("I"))
    stays = np.concatenate([[0], np.cumsum(letters != ord("D"))])
    ends = np.cumsum([row["part"]["eaten"] for row in parts])
    cuts = [0, *(int(eats[e - 1]) + 1 if e else 0 for e in ends[:-1]), len(audit)]
    kind = table.schema.field("conv").type
    rows = [{"conv": parts[0]["conv"], **_facts(counts, low, high, (cost, audit))}]
    rows += [
        {"conv": row["conv"], "segment": row["segment"], "edits": audit[a:b], "place": int(stays[a]), "odd": bool(stays[-1] % 2)}
        for row, a, b in zip(parts, cuts, cuts[1:])
    ]
    fields = [("conv", kind), *[(n, pa.int64() if k == "long" else pa.string()) for n, k in FACTS]]
    fields += [("segment", pa.int64()), ("edits", pa.string()), ("place", pa.int64()), ("odd", pa.bool_())]
    return pa.table({n: pa.array([r.get(n) for r in rows], t) for n, t in fields})


def _edit_part(rows: pa.Table, plan: pa.Table) -> pa.Table:
    """The turns that a part keeps, gets a new role or inserts."""
    todo, rows = plan.to_pylist()[0], rows.sort_by("place")
    given = [(r["gone"], r["role"], r["text"]) for r in rows["row"].to_pylist()]
    turns = list(edited(given, todo["edits"], todo["place"], todo["odd"]))
    return pa.table({
        "conv": pa.array([todo["conv"]] * len(turns), plan.schema.field("conv").type),
        "place": pa.array(range(todo["place"], todo["place"] + len(turns)), pa.int64()),
        **{n: pa.array([t[k] for t in turns], pa.string()) for k, n in enumerate(("role", "text", "edit"))},
    })


@dataclass
class Repaired:
    """`conversations`: one row each with `conv`, counts, `cost`, `audit` and `repaired`, an array of (role, text, edit).

    `repaired` is null for conversations that went through several tasks; their turns are rows of `turns`: `conv`, `place`, `role`,
    `text`, `edit`.
    """

    conversations: DataFrame
    turns: DataFrame | None = None


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    here = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    named = rows.select(
        F.col(conv).alias("conv"), here.alias("present"), F.when(here, F.col(turn).cast("long")).alias("turn"),
        F.when(here, F.coalesce(F.col(role), F.lit(" "))).otherwise("").alias("role"),
        F.when(here, F.coalesce(F.col(text), F.lit(" "))).otherwise("").alias("text"),
    )
    return named


def _judged(rows: DataFrame) -> DataFrame:
    """With the row's own faults, and keys of its role and text."""
    ended = F.rtrim("text", F.lit(SPACES))
    a, b = hash_pair("role", "text")
    return rows.withColumns({
        "blank": ended == "", "unfinished": ~F.substring(ended, -1, 1).isin(STOPS),
        KEY[0]: a, KEY[1]: b, "begins": F.substring("text", 1, PREFIX),
    })


ORDER = ["conv", "turn", "role", "begins", *KEY]


def _least(turn: Column) -> Column:
    """The first turn, null before any number."""
    return F.when(F.count("*") == F.count(turn), F.min(turn)).alias("turn")


def _long(rows: DataFrame) -> DataFrame:
    """Keys of the conversations that one task should not hold."""
    a, b = hash_pair("conv")
    sizes = rows.groupBy(a.alias("conv_a"), b.alias("conv_b")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    return stored(sizes.where((F.col("n") > LONG) | (F.col("bytes") > LONG_BYTES)).select("conv_a", "conv_b"), "long-conversations")


def _out(rows: DataFrame, run: Callable) -> DataFrame:
    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv {kind}, {OUT_FACTS}, repaired array<{TURN}>, segment long, part {PART}, place long, row struct<gone long, role string, text string>")


def _repaired_in_parts(rows: DataFrame) -> Repaired:
    kind = rows.schema["conv"].dataType.simpleString()
    counted = stored(_judged(rows.groupBy("conv", "turn", "role", "text", "present").agg(F.count("*").alias("times"))), "counted-turns")
    firsts = (
        counted.where(F.col("present") & ~F.col("blank")).groupBy("conv", "role", "begins", *KEY).agg(_least(F.col("turn")))
        .withColumn("mark", F.lit(True))
    )
    marked = counted.withColumn("mark", F.lit(False)).unionByName(firsts, allowMissingColumns=True)
    dealt = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER, F.desc("mark"))
    found = stored(_out(dealt, _repair_parts), "repaired-parts")
    plans = stored(found.where(F.col("part").isNotNull()).select("conv", "segment", "part").groupBy("conv").applyInArrow(
        _join_parts, f"conv {kind}, {OUT_FACTS}, segment long, edits string, place long, odd boolean"
    ), "repair-plans")
    names = ["conv", *[name for name, _ in FACTS]]
    whole = found.where(F.col("cost").isNotNull()).select(*names, "repaired")
    split = plans.where(F.col("segment").isNull()).select(*names, F.lit(None).cast(f"array<{TURN}>").alias("repaired"))
    pending = found.where(F.col("row").isNotNull()).select("segment", "place", "row")
    todo = plans.where(F.col("segment").isNotNull()).select("conv", "segment", "edits", "place", "odd")
    turns = pending.groupBy("segment").cogroup(todo.groupBy("segment")).applyInArrow(
        _edit_part, f"conv {kind}, place long, role string, text string, edit string"
    )
    return Repaired(whole.unionByName(split), turns)


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None,
) -> Repaired:
    """The faults of every conversation and its cheapest repair."""
    rows = _prepared(rows, conv, turn, role, text, present)
    long = _long(rows)
    count = long.count()
    a, b = hash_pair("conv")
    if count:
        keyed = rows.withColumns({"conv_a": a, "conv_b": b})
        on = ["conv_a", "conv_b"]
        short = only_keys(keyed, long, on, count, "left_anti").drop(*on)
        rest = _repaired_in_parts(only_keys(keyed, long, on, count).drop(*on))
    else:
        short, rest = rows, None
    judged = _judged(short).withColumns({"times": F.lit(1), "mark": F.lit(False)})
    whole = _out(judged.repartition("conv").sortWithinPartitions(*ORDER), _repair_whole)
    whole = whole.select("conv", *[name for name, _ in FACTS], "repaired")
    return Repaired(whole) if rest is None else Repaired(whole.unionByName(rest.conversations), rest.turns)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None

    def row(kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv": pa.array([now], kind), "digest": pa.array([state.hexdigest()])})

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, line in zip(batch["conv"].to_pylist(), batch["line"].to_pylist()):
            if state is None or conv != now:
                if state is not None:
                    yield row(kind)
                now, state = conv, hashlib.sha256(line.encode())
            else:
                state.update(b"\n" + line.encode())
    if state is not None:
        yield row(kind)


def with_digest(found: Repaired, name: str) -> DataFrame:
    """The conversations with the SHA-256 of their repaired `role:text` lines.

    Those that went through several tasks are read in order as a stream: a task holds one batch of lines of a conversation.
    """
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    whole = found.conversations.withColumn(name, F.sha2(F.array_join(lines, "\n").cast("binary"), 256))
    if found.turns is None:
        return whole
    kind = found.turns.schema["conv"].dataType.simpleString()
    ordered = found.turns.select("conv", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = ordered.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "line").mapInArrow(
        _digests, f"conv {kind}, digest string"
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    split = whole.where(F.col("repaired").isNull()).drop(name).alias("w").join(digests.alias("d"), F.expr("w.conv <=> d.conv"), "left")
    split = split.select("w.*", F.coalesce("digest", nothing).alias(name))
    return whole.where(F.col("repaired").isNotNull()).unionByName(split)
