"""Text of Arrow batches as numpy arrays: words, shingles and rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time; a longer single text is taken whole. Arrays need about 40 bytes each.
CHUNK = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64, from 0 to n at least."""
    if len(_powers[0]) <= n:
        size = max(2 * CHUNK, n + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[k] = np.multiply.accumulate(run)
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which `span_hash` gives the hash of any run of the values."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal runs of values have equal hashes, wherever they start."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text or binary column as one large_binary array; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return column.cast(pa.large_binary()).fill_null(b"")


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of its rows in them) of runs of whole texts."""
    column = binary(column)
    if len(column) == 0:
        return
    _, at, body = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z taken as a-z."""
    return _LOWER[data]


def words(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, A-Z taken as a-z, between ASCII white space or other bytes: (hashes, starts, ends, first word of each text and the count)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    space = between[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before[cuts], after[cuts - 1] = True, True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    hashes = span_hash(prefix_sums(lowered(data)), starts, ends)
    return hashes, starts, ends, np.searchsorted(starts, offsets)


@cache
def _factors(size: int) -> np.ndarray:
    return mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def shingles(hashes: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words, in order, and where each text's begin.

    A text with fewer words has one, of all its words; a text without words has none.
    """
    counts = np.diff(firsts)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(made)])
    if len(hashes) == 0:
        return hashes, begins
    at = np.arange(begins[-1]) - np.repeat(begins[:-1] - firsts[:-1], made)
    end = np.repeat(firsts[1:], made)
    total = np.zeros(len(at), np.uint64)
    for j, factor in enumerate(_factors(size)):
        here = at + j
        total += np.where(here < end, hashes[np.minimum(here, len(hashes) - 1)], np.uint64(0)) * factor
    return mix(total), begins


def chunk_shingles(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the shingles in order, where each text's begin and the last's end) of runs of whole texts."""
    for first, data, offsets in chunks(column):
        hashes, _, _, firsts = words(data, offsets)
        yield first, *shingles(hashes, firsts, size)


def text_shingles(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its shingles in order) of every row of a column."""
    for first, values, begins in chunk_shingles(column, size):
        for k in range(len(begins) - 1):
            yield first + k, values[begins[k] : begins[k + 1]]


def code_points(texts: list[str]) -> np.ndarray:
    """All characters of the texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)


@cache
def char_table(kind: str) -> np.ndarray:
    """For every code point, whether `str.<kind>()` holds."""
    test = getattr(str, kind)
    return np.fromiter((test(chr(c)) for c in range(0x110000)), bool, 0x110000)


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one numpy array for each row."""
    lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
