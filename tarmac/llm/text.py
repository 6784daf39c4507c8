"""Words, lines and hashes of whole Arrow batches of text, as numpy arrays.

A batch is worked through in chunks of bounded bytes (one document at least), so memory follows
``CHUNK_BYTES`` and the longest document, never the batch or the partition. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

# The white space that separates words: blank and U+0009 to U+000D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_PLACE = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64.

    Those for a chunk are kept; longer rows, which are chunks of their own, have theirs made anew.
    """
    if n > CHUNK_BYTES or not _powers:
        size = max(n, CHUNK_BYTES)
        made = {}
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, np.uint64(base), dtype=np.uint64)
            steps[0] = 1
            made[name] = np.multiply.accumulate(steps)
        if n > CHUNK_BYTES:
            return made["up"], made["down"]
        _powers.update(made)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of at most ``limit`` bytes or one row."""
    limit = CHUNK_BYTES if limit is None else limit
    raw, offsets = text_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of ``inside`` that stays within one row."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes; ``lower`` folds A-Z."""
    if len(raw) == 0 or len(starts) == 0:
        return np.zeros(len(starts), np.uint64)
    up, down = powers(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER if lower else _BYTE)[raw] * up, out=sums[1:])
    at = np.minimum(starts, len(raw) - 1)
    return mix((sums[ends] - sums[starts]) * down[at] + (ends - starts).astype(np.uint64))


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and hash of every word."""
    starts, ends, rows = spans(~SPACE[raw], offsets)
    return starts, ends, rows, span_hashes(raw, starts, ends, lower)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` items that begin at each place (fewer places than items)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(size), np.uint64)
    for j in range(size):
        total += hashes[j : j + n] * _PLACE[j % 64]
    return mix(total)


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all shingles, sorted and distinct.

    A row of fewer words than ``size`` has its whole sequence as its one shingle; without words it
    has none.
    """
    counts = np.bincount(rows, minlength=n_rows)
    got = grams(hashes, size)
    same = rows[: len(got)] == rows[size - 1 :] if len(got) else np.zeros(0, bool)
    row, value = rows[: len(got)][same], got[same]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        first = np.concatenate(([0], np.cumsum(counts)))[few]
        extra = np.empty(len(few), np.uint64)
        for length in range(1, size):
            pick = counts[few] == length
            total = np.full(int(pick.sum()), np.uint64(length), np.uint64)
            for j in range(length):
                total += hashes[first[pick] + j] * _PLACE[j]
            extra[pick] = mix(total)
        row, value = np.concatenate((row, few)), np.concatenate((value, extra))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]
