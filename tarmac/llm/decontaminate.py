"""Passages of benchmark items in documents.

A window has as many words as an item. Its SimHash fingerprint is looked up in an index of blocks of
the items' fingerprints: if two fingerprints differ in at most RADIUS bits, then by pigeonhole some
block of theirs differs in at most RADIUS // BLOCKS bits, so the index finds all of them. What it
finds is judged by the exact similarity of the weighted sets of shingles. Windows that hold too few
shingles of the benchmark to reach the similarity can't match and are not fingerprinted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

SHINGLE = 5
SIMILARITY = 0.8
# Fingerprints of 256 bits in 32 blocks of 8. At a similarity of 0.8 about 40 bits differ, with a
# standard deviation under 7; unrelated ones differ in 128, give or take 8.
WORDS = 4
BLOCKS = 32
RADIUS = 92
# Items are searched in blocks of so many bytes of text, each in one pass over the documents.
BLOCK_BYTES = 4 << 20

# Words are runs of ASCII letters and digits and of all bytes outside ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)

FOUND = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, rows = tx.spans(_WORD[raw], offsets)
    return rows, tx.span_hashes(raw, starts, ends, lower=True)


def fingerprint(shingles: np.ndarray) -> np.ndarray:
    """The 256-bit SimHash of a weighted set given with its repetitions, as 32 bytes."""
    votes = np.zeros(256, np.int32)
    for k in range(WORDS):
        bits = np.unpackbits(tx.mix(shingles + np.uint64(k * 7919 + 1)).view(np.uint8).reshape(-1, 8), axis=1)
        votes[64 * k : 64 * k + 64] = 2 * bits.sum(axis=0, dtype=np.int32) - len(shingles)
    return np.packbits(votes > 0)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller weights over that of the larger ones; a weight is a number of repetitions."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(nx[i], ny[j]).sum())
    return both / (len(a) + len(b) - both)


class Items:
    """The shingles, lengths and block index of some benchmark items."""

    def __init__(self, ids: list[int], texts: list[str]):
        column = pa.array(texts, pa.large_string())
        raw, offsets = tx.text_buffers(column)
        rows, hashes = _words(raw, offsets)
        counts = np.bincount(rows, minlength=len(ids))
        first = np.concatenate(([0], np.cumsum(counts)))
        self.ids, self.length, self.shingles = [], [], []
        for i, item in enumerate(ids):
            if counts[i]:
                size = min(SHINGLE, int(counts[i]))
                self.ids.append(item)
                self.length.append(int(counts[i]))
                self.shingles.append(tx.grams(hashes[first[i] : first[i + 1]], size))
        self.prints = np.array([fingerprint(s) for s in self.shingles], np.uint8).reshape(-1, BLOCKS)
        # For every size of shingle: its hashes, and the lengths of the items that hold each.
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {min(SHINGLE, n) for n in self.length}:
            own = [(s, n) for s, n in zip(self.shingles, self.length, strict=True) if min(SHINGLE, n) == size]
            value = np.concatenate([s for s, _ in own])
            length = np.concatenate([np.full(len(s), n) for s, n in own])
            order = np.lexsort((length, value))
            self.by_size[size] = (value[order], length[order])
        near = [np.flatnonzero(_POP[np.arange(256) ^ v] <= RADIUS // BLOCKS) for v in range(256)]
        self.index: list[list[np.ndarray]] = []
        for b in range(BLOCKS):
            holders = [np.flatnonzero(self.prints[:, b] == v) for v in range(256)]
            self.index.append([np.concatenate([holders[w] for w in near[v]]) for v in range(256)])

    def within(self, mark: np.ndarray) -> np.ndarray:
        """All items whose fingerprint is within the radius."""
        seen = np.zeros(len(self.ids), bool)
        for b in range(BLOCKS):
            seen[self.index[b][mark[b]]] = True
        at = np.flatnonzero(seen)
        return at[_POP[self.prints[at] ^ mark].sum(axis=1, dtype=np.int32) <= RADIUS]

    def search(self, raw: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[float, int, int]]:
        """The best (similarity, first word, words) for each (row, item) that reaches the similarity."""
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        rows, hashes = _words(raw, offsets)
        counts = np.bincount(rows, minlength=len(offsets) - 1)
        first = np.concatenate(([0], np.cumsum(counts)))
        for size, (value, length) in self.by_size.items():
            grams = tx.grams(hashes, size)
            if not len(grams):
                continue
            inside = rows[: len(grams)] == rows[size - 1 :]
            at = np.searchsorted(value, grams)
            hit = inside & (value[np.minimum(at, len(value) - 1)] == grams)
            hits = np.flatnonzero(hit)
            if not len(hits):
                continue
            total = np.concatenate(([0], np.cumsum(hit)))
            ends = np.searchsorted(value, grams[hits], "right")
            for row in np.unique(rows[hits]).tolist():
                own = hits[np.searchsorted(hits, first[row]) : np.searchsorted(hits, first[row + 1])]
                where = np.searchsorted(hits, own)
                sizes = np.unique(np.concatenate([length[a:b] for a, b in zip(at[own], ends[where], strict=True)]))
                for n in sizes.tolist():
                    self._windows(row, n, size, first[row], int(counts[row]), own, total, grams, best)
        return best

    def _windows(self, row, n, size, begin, words, own, total, grams, best) -> None:
        """The windows of ``n`` words, or the whole text if it has fewer, around the shingles at ``own``."""
        width = min(n, words) - size + 1
        if width < 1:
            return
        # Weights add up to one for each shingle, so a similar window holds at least so many.
        need = SIMILARITY * (width + n - size + 1) / (1 + SIMILARITY) - 1e-9
        starts = np.unique((own[:, None] - np.arange(width)[None, :]).ravel())
        starts = starts[(starts >= begin) & (starts + width + size - 1 <= begin + words)]
        starts = starts[total[starts + width] - total[starts] >= need]
        for start in starts.tolist():
            window = grams[start : start + width]
            for k in self.within(fingerprint(window)).tolist():
                if self.length[k] != n:
                    continue
                s = similarity(window, self.shingles[k])
                if s >= SIMILARITY:
                    key, found = (row, k), (s, start - begin, width + size - 1)
                    if key not in best or (-s, found[1]) < (-best[key][0], best[key][1]):
                        best[key] = found


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """The items in blocks of at most ``BLOCK_BYTES`` of text (or one item)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    ids: list[int] = []
    texts: list[str] = []
    held = 0
    for r in items.toLocalIterator():
        if ids and held + len(r["text"]) > BLOCK_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        held += len(r["text"])
    if ids:
        yield ids, texts


_items: dict[int, Items] = {}


def _items_of(ids: list[int], texts: list[str]) -> Items:
    key = hash((tuple(ids), tuple(texts)))
    if key not in _items:
        _items.clear()
        _items[key] = Items(ids, texts)
    return _items[key]


def _found(batches: Iterator[pa.RecordBatch], ids: list[int], texts: list[str]) -> Iterator[pa.RecordBatch]:
    items = _items_of(ids, texts)
    for batch in batches:
        for lo, _, raw, offsets in tx.chunks(batch.column("text")):
            best = items.search(raw, offsets)
            if best:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([lo + r for r, _ in best], pa.int64())),
                        pa.array([items.ids[k] for _, k in best], pa.int64()),
                        pa.array([v[0] for v in best.values()], pa.float64()),
                        pa.array([v[1] for v in best.values()], pa.int64()),
                        pa.array([v[2] for v in best.values()], pa.int64()),
                    ],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"],
                )


def _clean(batches: Iterator[pa.RecordBatch], ids: list[int], texts: list[str]) -> Iterator[pa.RecordBatch]:
    items = _items_of(ids, texts)
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for lo, _, raw, offsets in tx.chunks(batch.column("text")):
            for row, _ in items.search(raw, offsets):
                keep[lo + row] = False
        yield batch.filter(pa.array(keep))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` and each item that it holds: doc_id, item_id, similarity,
    first_word and n_words of the best window (the first of equals).

    Words are runs of letters and digits, A-Z lowered; sets are of five-word shingles (a shorter item
    is one shingle), weighted by repetition. A text shorter than an item is one window. Null and empty
    texts or items hold nothing. Repeated rows are reported one by one, equal items each by its id.
    Other columns are not looked at. Without documents or items the result is empty.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for ids, texts in _blocks(benchmark):
        part = docs.mapInArrow(partial(_found, ids=ids, texts=texts), FOUND)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], FOUND) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; nothing is shuffled."""
    for ids, texts in _blocks(benchmark):
        docs = docs.mapInArrow(partial(_clean, ids=ids, texts=texts), docs.schema)
    return docs
