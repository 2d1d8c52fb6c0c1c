"""Suffix-array dedup: maximal repeats from enhanced suffix arrays of anchored pieces of text.

Texts are UTF-8 bytes. Every string of `WINDOW` bytes names an anchor: the place in it whose following `GRAM` bytes have the
smallest hash, the leftmost of equals. Equal strings name equal anchors at the same distance, so they meet if texts are
grouped by anchor. Windows in a row with one anchor make a piece: their bytes and the byte before them. Pieces whose anchor
occurs once in the table are left out before any text moves, and equal pieces are counted and then held once.

Pieces are dealt out by anchor. Each chunk of them gets a suffix array of the starts that can begin a maximal repeat:
those whose window is repeated (by hash) and is not always preceded by the same byte, and the first of each piece. Its
longest-common-prefix intervals are found by one scan with a stack. An interval that is at least `WINDOW` deep and whose
suffixes have different bytes on their left, or begin a piece, is a maximal repeat: its length is the depth, and its
occurrences are all its suffixes. Bytes are compared as they are, so hashes only choose what to compare. Repeats are
cut at the ends of pieces; the next piece's repeats go on from there.

An anchor with more than `HOT` different pieces, such as one in a passage that very many documents share, is not sorted in one
task: its windows are counted by hash, with partial sums, and the repeated ones are repeats of `WINDOW` bytes.

Every byte in a repeat is removed, wherever it stands. A null text counts as empty. Rows are documents, so equal rows repeat each
other's text. Texts shorter than a window keep all bytes. Texts are read whole; memory grows with the longest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.rows import KEY, dropped, hash_pair, keyed, stored, with_results
from tillstream.llm.text import binary, chunks, mix, prefix_sums, span_hash

WINDOW = 400
GRAM = 64
#: Different pieces of one anchor that are sorted together.
HOT = 4000
#: Bytes of pieces in one suffix array, beyond the last anchor's, and of texts whose anchors are taken at a time.
ARRAY_BYTES = 1_000_000
CHUNK = 1 << 18
#: Pieces that are cut out of a text at a time.
CUT_PIECES = 2_000
_PLACE_BITS = np.uint64(28)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` values in a row."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[: len(values) - (width - span)], values[width - span :])
    return values


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, first window, last window) of every piece of some texts; windows count from each text's start."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none.astype(np.uint64), none, none
    starts = np.arange(n - GRAM + 1)
    grams = span_hash(prefix_sums(data), starts, starts + GRAM)
    placed = (grams >> _PLACE_BITS << _PLACE_BITS) | starts.astype(np.uint64)
    at = (_least(placed, WINDOW - GRAM + 1) & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    windows = np.arange(len(at))
    text = np.searchsorted(offsets, windows, side="right") - 1
    inside = np.flatnonzero(windows + WINDOW <= offsets[text + 1])
    if not len(inside):
        return none, none.astype(np.uint64), none, none
    at, text = at[inside], text[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(inside)) - 1
    text = text[begin]
    return text, grams[at[begin]], inside[begin] - offsets[text], inside[end] - offsets[text]


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in chunks(batch.column(2), CHUNK):
            text, anchor, a, b = anchors(data, offsets)
            rows = pa.array(first + text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(_signed(anchor)), pa.array(a), pa.array(b)],
                ["key_a", "key_b", "anchor", "first", "last"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of texts: (key, text, windows) to (key, anchor, start in the text, whether a byte is before, bytes)."""
    for batch in batches:
        texts, windows = binary(batch.column(2)), batch.column(3)
        for row in range(batch.num_rows):
            text, found = texts[row].as_py(), windows[row].as_py()
            # A few at a time: in a text of few letters each window is a piece of its own, and has all its bytes.
            for at in range(0, len(found), CUT_PIECES):
                some = found[at : at + CUT_PIECES]
                bodies = [text[max(0, w["first"] - 1) : w["last"] + WINDOW] for w in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([batch.column(k)[row].as_py()] * len(some), pa.int64()) for k in range(2)),
                        pa.array([w["anchor"] for w in some], pa.int64()),
                        pa.array([max(0, w["first"] - 1) for w in some], pa.int64()),
                        pa.array([w["first"] > 0 for w in some], pa.bool_()), pa.array(bodies, pa.binary()),
                    ],
                    ["key_a", "key_b", "anchor", "start", "before", "piece"],
                )


class _Pieces:
    """A chunk of different pieces, laid end to end."""

    def __init__(self, pieces: list[bytes], before: np.ndarray, copies: np.ndarray) -> None:
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.raw = self.data.tobytes()
        self.ends = np.cumsum([len(p) for p in pieces])
        self.begins = self.ends - [len(p) for p in pieces]
        self.copies = copies
        counts = np.maximum(self.ends - self.begins - before - WINDOW + 1, 0)
        owner = np.repeat(np.arange(len(pieces)), counts)
        first = np.repeat(self.begins + before, counts)
        at = first + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        self.owner, self.at, self.edge = owner, at, at == first
        sums = prefix_sums(self.data)
        self.hash = span_hash(sums, at, at + WINDOW)
        # The byte before each window; a window that begins a text has none, and a sign that no byte has.
        self.left = np.where(self.edge & (np.asarray(before) == 0)[owner], 256, self.data[np.maximum(at, 1) - 1].astype(np.int64))

    def starts(self) -> np.ndarray:
        """Numbers of the windows that can begin a maximal repeat."""
        order = np.argsort(self.hash, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = self.hash[order][1:] != self.hash[order][:-1]
        begins = np.flatnonzero(new)
        if not len(begins):
            return begins
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        weight = np.add.reduceat(self.copies[self.owner[order]], begins)
        left = self.left[order]
        diverse = np.minimum.reduceat(left, begins) != np.maximum.reduceat(left, begins)
        return np.flatnonzero((weight >= 2)[group] & (diverse[group] | self.edge))


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def maximal_repeats(pieces: _Pieces) -> Iterator[tuple[int, np.ndarray]]:
    """(length, numbers of the windows where it occurs) of the maximal repeats of a chunk, deeper ones first."""
    starts = pieces.starts()
    ends = pieces.ends[pieces.owner[starts]]
    suffix = [pieces.raw[a:e] for a, e in zip(pieces.at[starts].tolist(), ends.tolist())]
    array = sorted(range(len(starts)), key=suffix.__getitem__)
    # What stands on the left: a byte, or, at a piece's edge, a sign of its own.
    left = np.where(pieces.edge, 256 + np.arange(len(pieces.at)), pieces.left)[starts]
    copies = pieces.copies[pieces.owner[starts]]
    stack: list[list] = []  # [depth, first suffix, a left sign, whether there are others]

    for k, number in enumerate(array):
        if copies[number] > 1:  # equal pieces hold this suffix more than once
            yield len(suffix[number]), starts[[number]]
        depth = _common(suffix[number], suffix[array[k + 1]]) if k + 1 < len(array) else 0
        begin, sign, diverse = k, int(left[number]), False
        while stack and stack[-1][0] > depth:
            top, first, other, mixed = stack.pop()
            begin, diverse = first, diverse or mixed or other != sign
            if diverse and top >= WINDOW:
                yield top, starts[[array[i] for i in range(first, k + 1)]]
        if stack and stack[-1][0] == depth:
            stack[-1][3] = stack[-1][3] or diverse or stack[-1][2] != sign
        elif depth:
            stack.append([depth, begin, sign, diverse])


def _spans(pieces: _Pieces) -> list[list[tuple[int, int]]]:
    """For each piece, the runs of its bytes that repeats cover."""
    cover = np.zeros(len(pieces.at), np.int64)
    for length, windows in maximal_repeats(pieces):
        cover[windows] = np.maximum(cover[windows], length)
    found: list[list[tuple[int, int]]] = [[] for _ in pieces.begins]
    for w in np.flatnonzero(cover):
        owner = pieces.owner[w]
        start = int(pieces.at[w] - pieces.begins[owner])
        end = start + int(cover[w])
        runs = found[owner]
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((start, end))
    return found


SPANS = "array<struct<start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of their anchors, to (piece's name, spans). An array holds whole anchors."""
    held: list[tuple] = []
    size = 0

    def done():
        pieces = _Pieces([h[3] for h in held], np.array([h[4] for h in held], np.int64), np.array([h[5] for h in held]))
        spans = _spans(pieces)
        some = [k for k, s in enumerate(spans) if s]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held[k][1] for k in some], pa.int64()), pa.array([held[k][2] for k in some], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in spans[k]] for k in some], _SPAN_TYPE),
            ],
            ["piece_a", "piece_b", "spans"],
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "piece_a", "piece_b", "piece", "before", "copies"))):
            if held and size > ARRAY_BYTES and row[0] != held[-1][0]:
                yield done()
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield done()


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a hot anchor's pieces: (piece's name, copies, place, two hashes)."""
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part = batch.slice(k, 200)
            pieces = _Pieces(
                part.column("piece").to_pylist(), np.array(part.column("before").to_pylist(), np.int64),
                part.column("copies").to_numpy(),
            )
            rows = part.select(["piece_a", "piece_b", "copies"]).take(pa.array(pieces.owner))
            second = span_hash(prefix_sums(mix(pieces.data.astype(np.uint64))), pieces.at, pieces.at + WINDOW)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("piece_a"), rows.column("piece_b"), rows.column("copies"),
                    pa.array(pieces.at - pieces.begins[pieces.owner]), pa.array(_signed(pieces.hash)), pa.array(_signed(second)),
                ],
                ["piece_a", "piece_b", "copies", "at", "a", "b"],
            )


def _hot_spans(hot: DataFrame) -> DataFrame:
    """(piece's name, spans) of the pieces of hot anchors."""
    windows = hot.mapInArrow(_window_rows, "piece_a long, piece_b long, copies long, at long, a long, b long")
    often = windows.groupBy("a", "b").agg(F.sum("copies").alias("n")).where("n > 1").select("a", "b")
    repeated = windows.join(often, ["a", "b"]).select("piece_a", "piece_b", "at")
    order = "over (partition by piece_a, piece_b order by at)"
    runs = repeated.withColumn("new", F.expr(f"at > coalesce(lag(at) {order} + {WINDOW}, -1)")).withColumn(
        "run", F.expr(f"sum(cast(new as int)) {order}")
    ).groupBy("piece_a", "piece_b", "run").agg(F.min("at").alias("start"), (F.max("at") + WINDOW).alias("end"))
    return runs.groupBy("piece_a", "piece_b").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(key, spans): the repeated bytes of every text of (key, text) that has any, unordered and overlapping."""
    found = stored(
        rows.select(*KEY, "text").mapInArrow(_anchor_rows, "key_a long, key_b long, anchor long, first long, last long"),
        "anchors",
    )
    often = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    windows = found.join(often, "anchor").groupBy(*KEY).agg(
        F.collect_set(F.struct("anchor", "first", "last")).alias("windows")
    )
    cut = rows.select(*KEY, "text").join(windows, KEY).mapInArrow(
        _cut, "key_a long, key_b long, anchor long, start long, before boolean, piece binary"
    )
    a, b = hash_pair("anchor", "before", "piece")
    pieces = stored(cut.withColumns({"piece_a": a, "piece_b": b}), "pieces")
    dropped(found)
    different = pieces.groupBy("anchor", "piece_a", "piece_b", "before", "piece").agg(F.count("*").alias("copies"))
    different = stored(different, "different")
    hot = different.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("anchor")
    hot = stored(hot, "hot")
    schema = T.StructType.fromDDL(f"piece_a long, piece_b long, spans {SPANS}")
    spans = (
        different.join(hot, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_arrays, schema).unionAll(_hot_spans(different.join(hot, "anchor", "left_semi")))
    )
    places = pieces.select(*KEY, "start", "piece_a", "piece_b").distinct()
    covered = places.join(spans, ["piece_a", "piece_b"]).select(
        *KEY, F.transform("spans", lambda s: F.struct(
            (s["start"] + F.col("start")).alias("start"), (s["end"] + F.col("start")).alias("end")
        )).alias("spans")
    )
    covered = stored(covered.groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("spans")), "covered")
    for table in (pieces, different, hot):
        dropped(table)
    return covered


RESULTS = ["n_bytes", "n_removed", "n_spans", "spans", "kept"]


def _taken_out(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, sizes, removed, spans, kept = binary(batch.column(1)), [], [], [], []
        for text, found in zip(texts, batch.column(2)):
            text, runs, parts, at = text.as_py(), [], [], 0
            for span in sorted((s["start"], s["end"]) for s in found.as_py() or ()):
                if runs and span[0] <= runs[-1][1]:
                    runs[-1] = (runs[-1][0], max(runs[-1][1], span[1]))
                else:
                    runs.append(span)
            for a, b in runs:
                parts.append(text[at:a])
                at = b
            parts.append(text[at:])
            sizes.append(len(text))
            removed.append(sum(b - a for a, b in runs))
            spans.append([{"start": a, "end": b} for a, b in runs])
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, _SPAN_TYPE), pa.array(kept, pa.binary()),
            ],
            names,
        )


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The table with `n_bytes`, `n_removed`, `n_spans`, the removed `spans` and the `kept` bytes of each text."""
    rows = keyed(docs, id_column, text_column)
    joined = rows.join(repeated_spans(rows), KEY, "left").select("row", "text", "spans")
    schema = T.StructType([
        joined.schema["row"], *T.StructType.fromDDL(f"n_bytes long, n_removed long, n_spans long, spans {SPANS}, kept binary")
    ])
    return with_results(joined.mapInArrow(lambda b: _taken_out(b, schema.names), schema), docs, RESULTS)
