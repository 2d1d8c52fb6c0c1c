"""Benchmark decontamination: q-gram filtering in diagonal bands, verified by banded alignment.

Texts are compared as lower-case letters and digits, with one blank between words. A benchmark item is searched as a
whole, or, if it is longer than `SEGMENT` characters, as overlapping segments of that length. A segment of
length L may differ by at most e = `ERRORS` * L edits. By the q-gram lemma, a passage within e edits shares at least
L - q + 1 - q * e of the segment's q-grams, on diagonals that lie within e of each other. So the q-grams of a
document that a segment has too are counted by (segment, band of 2 * (e + 1) diagonals); bands begin every e + 1
diagonals and overlap, so any e + 1 neighbouring diagonals lie within one. Bands that reach the bound are aligned with the
segment, in a band of diagonals.

Items with fewer than `SHORTEST` compared characters have too few q-grams for that, and are searched without edits, as whole words,
by an automaton.

The index of the benchmark goes to the executors in blocks of at most some `BLOCK_CHARS` characters, one pass over the
documents for each, whatever the benchmark's size; what a pass found is written before the next one. Documents are not
shuffled and each is judged alone, so copies and a hot source need no care. Whole texts are read; memory grows with the
longest text.

Items that are null, or have no letter or digit, are searched nowhere. Documents that
are null or empty hold nothing. Repeated items are found once each; repeated documents get equal results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.rows import dropped, stored, with_results
from tillstream.llm.text import char_table, code_points, mix

Q = 10
ERRORS = 0.06
SEGMENT = 160
SHORTEST = 40
BLOCK_CHARS = 4_000_000
#: Characters of documents that are searched at a time.
CHUNK = 1 << 19
_BITS = 22
_FACTORS = mix(np.arange(1, Q + 1, dtype=np.uint64)) | np.uint64(1)


def compared(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compared characters of some texts, where each one's begin, and each character's place in its text.

    A character whose lower case is longer than itself is taken as it is, so that places stay those of the text.
    """
    lower = [low if len(low := t.lower()) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for t in texts]
    lengths = np.fromiter((len(t) for t in lower), np.int64, len(lower))
    chars, begins = code_points(lower), np.concatenate([[0], np.cumsum(lengths)])
    word = char_table("isalnum")[chars]
    after = np.zeros(len(chars), bool)
    after[1:] = word[:-1]
    after[begins[:-1][begins[:-1] < len(chars)]] = False
    kept = word | after
    place = np.arange(len(chars)) - np.repeat(begins[:-1], lengths)
    counts = np.concatenate([[0], np.cumsum(kept)])
    return np.where(word, chars, np.uint32(32))[kept], counts[begins], place[kept]


def _grams(chars: np.ndarray) -> np.ndarray:
    total = np.zeros(max(0, len(chars) - Q + 1), np.uint64)
    for j, factor in enumerate(_FACTORS):
        total += chars[j : j + len(total)].astype(np.uint64) * factor
    return mix(total)


def _as_text(chars: np.ndarray) -> str:
    return chars.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


@dataclass(frozen=True)
class Segment:
    item: int
    chars: np.ndarray

    @property
    def edits(self) -> int:
        return int(ERRORS * len(self.chars))

    @property
    def shared(self) -> int:
        """Q-grams that a passage within the edits shares at least."""
        return len(self.chars) - Q + 1 - Q * self.edits


class Index:
    """The q-grams of a block of items, with the segments and places that have them."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.segments: list[Segment] = []
        self.short: dict[str, list[int]] = {}
        for item, text in items:
            chars, _, _ = compared([text])
            chars = chars[: len(chars) - 1] if len(chars) and chars[-1] == 32 else chars
            if len(chars) < SHORTEST:
                if len(chars):
                    self.short.setdefault(_as_text(chars), []).append(item)
                continue
            last = max(0, len(chars) - SEGMENT)
            for start in sorted({*range(0, last, SEGMENT // 2), last}):
                self.segments.append(Segment(item, chars[start : start + SEGMENT]))
        own = [_grams(s.chars) for s in self.segments]
        grams = np.concatenate([*own, np.zeros(0, np.uint64)])
        order = np.argsort(grams, kind="stable")
        segment = np.repeat(np.arange(len(own)), [len(g) for g in own])[order] if own else np.zeros(0, np.int64)
        place = np.concatenate([*(np.arange(len(g)) for g in own), np.zeros(0, np.int64)])[order]
        self.grams, begins = np.unique(grams[order], return_index=True)
        self.begins = np.append(begins, len(order))
        self.segment, self.place = segment.astype(np.int64), place.astype(np.int64)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.grams >> np.uint64(64 - _BITS)] = True
        self.band = np.array([s.edits + 1 for s in self.segments], np.int64)
        self.shared = np.array([s.shared for s in self.segments], np.int64)

    def search_short(self, chars: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text's number, item, start, end) of the short items that stand in the texts as whole words."""
        if not self.short or not len(chars):
            return
        if not hasattr(self, "automaton"):  # made where it is used
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for pattern, found in self.short.items():
                self.automaton.add_word(pattern, (len(pattern), found))
            self.automaton.make_automaton()
        for text in range(len(begins) - 1):
            body = _as_text(chars[begins[text] : begins[text + 1]])
            for last, (size, found) in self.automaton.iter(body):
                start, end = last + 1 - size, last + 1
                if (start == 0 or body[start - 1] == " ") and (end == len(body) or body[end] == " "):
                    for item in found:
                        yield text, item, int(begins[text]) + start, int(begins[text]) + end

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, diagonal) of every q-gram that some characters share with a segment."""
        grams = _grams(chars)
        at = np.flatnonzero(self.seen[grams >> np.uint64(64 - _BITS)])
        found = np.searchsorted(self.grams, grams[at])
        same = self.grams[np.minimum(found, len(self.grams) - 1)] == grams[at]
        at, found = at[same], found[same]
        count = self.begins[found + 1] - self.begins[found]
        first = np.repeat(self.begins[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        posting = first + np.arange(count.sum())
        return self.segment[posting], np.repeat(at, count) - self.place[posting]

    def search(self, chars: np.ndarray, begins: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
        """text's number: (item, start, end, edits) of the passages found in it, as compared characters of all texts."""
        found = defaultdict(list)
        for text, item, start, end in self.search_short(chars, begins):
            found[text].append((item, start, end, 0))
        if not len(self.segments) or len(chars) < Q:
            return found
        segment, diagonal = self.hits(chars)
        width = self.band[segment]
        band = diagonal // width
        # Each hit counts for the band that begins at its own stretch of diagonals and for the one before.
        keys = np.concatenate([(segment << 40) + band + (1 << 30), (segment << 40) + band - 1 + (1 << 30)])
        keys, counts = np.unique(keys, return_counts=True)
        for key in keys[counts >= self.shared[keys >> 40]].tolist():
            s = self.segments[key >> 40]
            start = ((key & ((1 << 40) - 1)) - (1 << 30)) * (s.edits + 1)
            # The stretch of a band, cut at the ends of each text that it meets.
            low, high = max(0, start - s.edits), min(len(chars), start + 3 * s.edits + 2 + len(s.chars))
            for text in range(int(np.searchsorted(begins, low, "right")) - 1, int(np.searchsorted(begins, high, "left"))):
                a, b = max(low, int(begins[text])), min(high, int(begins[text + 1]))
                if b - a >= len(s.chars) - s.edits and (hit := aligned(s.chars, chars[a:b], s.edits)):
                    found[text].append((s.item, a + hit[0], a + hit[1], hit[2]))
        return found


def aligned(pattern: np.ndarray, region: np.ndarray, edits: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best match of the pattern within a region, if it needs no more than `edits`.

    The region is as long as its band of diagonals and the pattern, so every cell of a row lies in the band. Deletions along a row
    are one running minimum.
    """
    n = len(region)
    steps = np.arange(n + 1)
    row, start = np.zeros(n + 1, np.int64), steps.copy()
    for i, char in enumerate(pattern):
        low, high = max(0, i - edits), n  # cells left of the band cannot reach the end within the edits
        new, new_start = np.full(n + 1, len(pattern) + n, np.int64), np.zeros(n + 1, np.int64)
        through = row[:-1] + (region != char)
        down = row + 1
        new[1:] = np.minimum(through, down[1:])
        new_start[1:] = np.where(through <= down[1:], start[:-1], start[1:])
        new[0], new_start[0] = down[0], start[0]
        new[:low] = len(pattern) + n
        level = new - steps
        best = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == best, steps, 0))
        row, start = best + steps, new_start[source]
        if row[low : high + 1].min() > edits:
            return None
    end = int(row.argmin())
    return (int(start[end]), end, int(row[end])) if row[end] <= edits else None


SPAN = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("edits", T.IntegerType()),
])
RESULTS = ["leaks", "contaminated"]


def _search(index: Index, texts: list[str]) -> list[list[dict]]:
    chars, begins, place = compared(texts)
    found = index.search(chars, begins)
    out = []
    for k in range(len(texts)):
        best = {}
        for item, start, end, edits in found.get(k, ()):
            span = (int(place[start]), int(place[end - 1]) + 1 if end > start else int(place[start]))
            if (item, *span) not in best or edits < best[item, *span]:
                best[item, *span] = edits
        out.append([
            {"item_id": i, "start": a, "end": b, "edits": e} for (i, a, b), e in sorted(best.items())
        ])
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The table with `leaks`, the passages (item, place in the text, edits) that each document shares, and `contaminated`."""
    items = benchmark.select(
        F.col(item_column).cast("long").alias("item"), F.col(item_text_column).alias("text")
    ).where(F.col("item").isNotNull() & F.col("text").isNotNull()).distinct()
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    found = docs.select(F.struct("*").alias("row"), F.col(text_column).alias("text"), F.array().cast(T.ArrayType(SPAN)).alias("leaks"))
    before = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).orderBy("item", "text")
        found = _with_block(found, [(r["item"], r["text"]) for r in own.toLocalIterator()])
        if block + 1 < blocks:
            found = stored(found, "leaks")
            if before is not None:
                dropped(before)
            before = found
    found = found.withColumn("contaminated", F.size("leaks") > 0)
    return with_results(found, docs, RESULTS)


def _with_block(found: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    """Add the passages of one block of items."""
    sent = found.sparkSession.sparkContext.broadcast(Index(items))
    schema = found.schema

    def run(batches):
        index = sent.value
        for batch in batches:
            leaks, part, size = [], [], 0
            for value in batch.column(1):
                part.append(value.as_py() or "")
                size += len(part[-1])
                if size > CHUNK:
                    leaks += _search(index, part)
                    part, size = [], 0
            leaks += _search(index, part)
            kind = batch.schema.field(2).type
            both = [(a or []) + b for a, b in zip(batch.column(2).to_pylist(), leaks)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, kind)], schema.names)

    return found.mapInArrow(run, schema)
