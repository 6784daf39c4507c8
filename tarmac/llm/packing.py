"""Best-fit-decreasing packing of token pieces, certified by lower bounds and repacked where it falls short.

Each group of pieces is packed by itself; dual-feasible functions give a lower bound on its number of
sequences. Groups that meet their bound keep all sequences but the emptiest. The others give up the
pieces of all their unfilled sequences. These pieces are dealt to new groups and packed again, until
one group holds them all or a round wins no sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import materialise

GROUP_ROWS = 50_000
END_ID = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches: Iterator[pa.RecordBatch], json_path: str, ranks_path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    made = bpe.encoder(json_path, ranks_path)
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, flat, bounds in made.batch(batch.column("text")):
            rows, piece, start, length, crc = [], [], [], [], []
            for i in range(len(bounds) - 1):
                own = np.append(flat[bounds[i] : bounds[i + 1]], np.uint32(END_ID)).astype("<u4")
                at, size = 0, len(own) % capacity or capacity
                k = 0
                while at < len(own):
                    rows.append(lo + i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(own[at : at + size].tobytes()))
                    at, size, k = at + size, capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound that two families of dual-feasible functions give on the number of bins."""
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int(counts @ size) // capacity)
    # Sizes over capacity - e fill a bin, those under e count nothing.
    up_to = np.concatenate(([0], np.cumsum(counts * size)))
    number = np.concatenate(([0], np.cumsum(counts)))
    for e in range(1, capacity // 2 + 1):
        large = number[-1] - number[capacity - e + 1]
        middle = up_to[capacity - e + 1] - up_to[e]
        best = max(best, int(large) + -(-int(middle) // capacity))
    # Sizes rounded down to multiples of capacity / k, unless (k + 1) of them fit exactly.
    for k in range(1, 21):
        exact = size * (k + 1) % capacity == 0
        value = np.where(exact, size * k, size * (k + 1) // capacity * capacity)
        best = max(best, -(-int(counts @ value) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece, and what is left in each bin: largest first, tightest bin.

    Equal lengths keep their order.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = by_room[left].pop()
            if not by_room[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, len(room)
            room.append(capacity)
        bins[i], offset[i] = b, capacity - left
        room[b] = left = left - size
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    return bins, offset, np.asarray(room, np.int64)


def _pack(batches: Iterator[pa.RecordBatch], capacity: int, turn: int) -> Iterator[pa.RecordBatch]:
    """One group: its pieces with sequence and offset, and whether the sequence is open to another round.

    Open are the unfilled sequences of a group that misses its bound, and the emptiest of any other.
    """
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    # The same pieces in any order of arrival pack alike.
    held = pa.Table.from_batches(parts).sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("uid", "ascending")])
    lengths = held.column("length").to_numpy().astype(np.int64)
    bins, offset, room = best_fit(lengths, capacity)
    free = (room > 0) & ((len(room) > lower_bound(lengths, capacity)) | (np.arange(len(room)) == room.argmax()))
    group = TaskContext.get().partitionId()
    out = held.append_column("sequence_id", pa.array((np.int64(turn) << 44) | (np.int64(group) << 20) | bins))
    yield from out.append_column("offset", pa.array(offset)).append_column("open", pa.array(free[bins])).to_batches()


PACKED = PIECES + ", uid long, sequence_id long, offset long, open boolean"


def pack(pieces: DataFrame, capacity: int = 2048, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (columns of ``PIECES``) with ``sequence_id`` and ``offset``.

    Every piece is at most ``capacity`` long; full pieces have a sequence each. A group holds about
    ``group_rows`` pieces in one task, whatever the size of the table, and rounds go on as long as they
    win. Ties are ordered by id and piece; repeated rows are packed like any others. An empty table
    gives an empty one.
    """
    pieces = materialise(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = F.col("uid").bitwiseOR(F.lit(1 << 62)).alias("sequence_id")
    done = pieces.where(F.col("length") == capacity).select("*", full, F.lit(0).cast("long").alias("offset"))
    pool = pieces.where(F.col("length") < capacity)
    # Pieces of open sequences, as packed so far.
    current, before, turn = None, 0, 0
    while n := pool.count():
        groups = -(-n // group_rows)
        dealt = pool.repartition(groups, F.xxhash64("uid", F.lit(turn)))
        again = materialise(dealt.mapInArrow(partial(_pack, capacity=capacity, turn=turn), PACKED), "packed")
        if current is not None and again.select("sequence_id").distinct().count() >= before:
            break
        if groups == 1:
            current = again
            break
        done = done.union(again.where("not open").select(done.columns))
        current = again.where("open")
        before = current.select("sequence_id").distinct().count()
        pool = current.select(*pieces.columns)
        turn += 1
    if current is not None:
        done = done.union(current.select(done.columns))
    return done.drop("uid")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, capacity: int = 2048) -> DataFrame:
    """One row for each piece of every row of ``docs``: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A document is its ids and then ``END_ID``; a null or empty text is the end id alone. Longer ones
    than ``capacity`` are cut from their end into full pieces, the first takes the rest. Only
    ``doc_id`` and ``text`` are used. Repeated rows, and rows without an id, are packed one by one. Very
    long texts are tokenized whole. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = partial(_pieces, json_path=json_path, ranks_path=ranks_path, capacity=capacity)
    return pack(docs.mapInArrow(made, PIECES), capacity)
