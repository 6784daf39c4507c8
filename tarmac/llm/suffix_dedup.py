"""Removal of bytes that repeat a string of ``LENGTH`` bytes found earlier, by suffix arrays of shards.

Which places can repeat at all is found first: every string of 100 bytes holds the smallest hash of
its 28-byte pieces (its anchor), so equal strings have equal anchors. Anchors that occur once drop out.
Of equal surroundings of an anchor (all strings that hold it) the first in the order of documents
stands for all, and the others are repeats. Surroundings that differ go to shards by anchor. In each
shard a suffix array is refined by doubling (Larsson-Sadakane: only groups not yet apart are sorted
again) until no two are alike; common prefixes of neighbours give the groups of equal strings. An
anchor with more surroundings than a shard holds is spread over shards, whose groups are merged by
binary search.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .common import materialise, shuffle_width

LENGTH = 100
PIECE = 28
REACH = LENGTH - PIECE
SHARD_BYTES = 1 << 20

ANCHORS = "ah long, ch long, doc_id long, pos long, lo int, hi int, own long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each window of ``width`` items, by its first item."""
    out, span = x, 1
    while 2 * span <= width:
        out = best(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return best(out[:-rest], out[rest:]) if rest else out


def anchors(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, place, hash, hash of the surroundings, and their reach to the left and right."""
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    n = len(raw)
    if n < LENGTH:
        return none
    up, down = tx.powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(tx._BYTE[raw] * up, out=sums[1:])
    size = np.diff(offsets)
    left_in_row = np.repeat(offsets[1:], size) - np.arange(n)
    h = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    h[: n - PIECE + 1] = tx.mix((sums[PIECE:] - sums[:-PIECE]) * down[: n - PIECE + 1]) >> np.uint64(1)
    h[left_in_row < PIECE] = np.iinfo(np.uint64).max
    least = _slide(h, REACH + 1, np.minimum)
    least = np.where(left_in_row[: len(least)] >= LENGTH, least, np.uint64(0))
    # A place is an anchor if the smallest hash of some whole string around it is its own.
    padded = np.concatenate((np.zeros(REACH, np.uint64), least, np.zeros(n - len(least), np.uint64)))
    at = np.flatnonzero(_slide(padded, REACH + 1, np.maximum)[:n] == h)
    row = np.searchsorted(offsets, at, "right") - 1
    lo = np.minimum(REACH, at - offsets[row])
    hi = np.minimum(LENGTH, offsets[row + 1] - at)
    a, b = at - lo, at + hi
    around = tx.mix((sums[b] - sums[a]) * down[a] + (lo * 1024 + hi).astype(np.uint64))
    return row, at - offsets[row], h[at].view(np.int64), around.view(np.int64), lo, hi


def later_copies(ah: np.ndarray, ch: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which rows have the same surroundings as a row before them in the order of documents."""
    _, back, count = np.unique(ch, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[back] > 1)
    at = at[np.lexsort((pos[at], doc[at], ah[at], ch[at]))]
    late = np.zeros(len(ch), bool)
    if len(at):
        turn = np.r_[True, (ch[at][1:] != ch[at][:-1]) | (ah[at][1:] != ah[at][:-1])]
        first = at[np.maximum.accumulate(np.where(turn, np.arange(len(at)), 0))]
        late[at] = (doc[first] != doc[at]) | (pos[first] != pos[at])
    return late


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors; those known here as repeats have their document in ``own``, so that they needn't meet
    the others of their anchor."""
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, _, raw, offsets in tx.chunks(batch.column("text")):
            row, pos, ah, ch, left, right = anchors(raw, offsets)
            if len(row):
                doc = ids.take(pa.array(row + lo)).to_numpy()
                own = pa.array(doc, mask=~later_copies(ah, ch, doc, pos))
                columns = [pa.array(ah), pa.array(ch), pa.array(doc), pa.array(pos), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), own]
                yield pa.RecordBatch.from_arrays(columns, ["ah", "ch", "doc_id", "pos", "lo", "hi", "own"])


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` codes at least; equal ones in any order."""
    n = len(codes)
    # Four codes at once where they fit in one number.
    bits = int(codes.max(initial=1) + 1).bit_length()
    lead = 4 if 4 * bits < 63 else 1
    padded = np.concatenate((codes + 1, np.zeros(lead, np.int64)))
    packed = padded[:n].copy()
    for k in range(1, lead):
        packed = packed << bits | padded[k : n + k]
    sa = np.argsort(packed)
    ordered = packed[sa]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[sa] = np.repeat(head, np.diff(np.append(head, n)))
    rank[n] = -1
    h = lead
    active = np.flatnonzero(np.repeat(np.diff(np.append(head, n)) > 1, np.diff(np.append(head, n))))
    while h < depth and len(active):
        sub = sa[active]
        # The ranks of both halves as one number.
        pair = rank[sub] * (n + 1) + rank[np.minimum(sub + h, n)] + 1
        order = np.argsort(pair)
        sub, pair = sub[order], pair[order]
        sa[active] = sub
        turn = np.r_[True, pair[1:] != pair[:-1]]
        # A group keeps the place of its first suffix as its rank.
        rank[sub] = active[np.maximum.accumulate(np.where(turn, np.arange(len(sub)), 0))]
        active = active[~(turn & np.r_[turn[1:], True])]
        h *= 2
    return sa


def common_prefixes(raw: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """The common prefix of each suffix and the next one in order, up to ``limit``.

    As in Kasai's method lengths are found in the order of the text, where a suffix shares at least
    one byte less than the one before it; blocks of the text are extended side by side.
    """
    n = len(sa)
    follow = np.full(n, n, np.int64)
    follow[sa[:-1]] = sa[1:]
    padded = np.concatenate((raw.astype(np.int64), -np.arange(1, limit + 2)))
    lcp = np.zeros(n, np.int64)
    block = 32
    for k in range(block):
        i = np.arange(k, n, block)
        i = i[follow[i] < n]
        got = np.maximum(lcp[i - 1] - 1, 0) if k else np.zeros(len(i), np.int64)
        if k:
            got[follow[i - 1] >= n] = 0
        live = np.flatnonzero(got < limit)
        while len(live):
            # Beyond the end no two numbers are alike.
            have = got[live]
            live = live[padded[i[live] + have] == padded[follow[i[live]] + have]]
            got[live] += 1
            live = live[got[live] < limit]
        lcp[i] = got
    out = np.zeros(n, np.int64)
    out[:-1] = lcp[sa[:-1]]
    return out


def repeated(parts: list[bytes], doc: np.ndarray, start: np.ndarray, lone: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all strings of ``LENGTH`` bytes in the parts: document, start, and group of equal ones.

    ``doc`` and ``start`` tell where each part begins. Groups are numbered; strings come by group and
    within it in the order of documents. Strings that have no equal are told only if ``lone``.
    """
    sizes = np.array([len(p) for p in parts])
    raw = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8)
    codes = raw.astype(np.int64)
    ends = np.cumsum(sizes + 1) - 1
    codes[ends] = 256 + np.arange(len(parts))  # no string runs on into the next part
    # All suffixes differ by the end of their part, so the order is whole, as Kasai's bound needs.
    sa = suffix_array(codes, int(sizes.max()) + 1)
    lcp = common_prefixes(codes, sa, LENGTH)
    part = np.repeat(np.arange(len(parts)), sizes + 1)[sa]
    valid = sa + LENGTH <= ends[part]
    group = np.cumsum(np.r_[True, lcp[:-1] < LENGTH])
    if not lone:
        valid &= np.bincount(group)[group] > 1
    sa, part, group = sa[valid], part[valid], group[valid]
    first = ends - sizes
    where = start[part] + sa - first[part]
    order = np.lexsort((where, doc[part], group))
    return doc[part][order], where[order], group[order]


def may_repeat(rows: list[tuple]) -> np.ndarray:
    """Which surroundings can share a string with others of their anchor; the rest can't.

    A string that reaches between 8k and 8k + 7 bytes to the left of the anchor shares 8k bytes there
    and at least 93 - 8k bytes from the anchor on.
    """
    sizes = np.array([len(r[1]) for r in rows])
    raw = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
    first = np.cumsum(sizes) - sizes
    lo = np.array([r[4] for r in rows])
    hi = sizes - lo
    at = first + lo
    up, down = tx.powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tx._BYTE[raw] * up)))
    anchor = np.array([r[0] for r in rows]).view(np.uint64)
    keep = np.zeros(len(rows), bool)
    for left in range(0, REACH + 1, 8):
        right = LENGTH - min(left + 7, REACH)
        fits = np.flatnonzero((lo >= left) & (hi >= right))
        a, b = at[fits] - left, at[fits] + right
        value = tx.mix((sums[b] - sums[a]) * down[a] ^ anchor[fits])
        _, back, count = np.unique(value, return_inverse=True, return_counts=True)
        keep[fits[count[back] > 1]] = True
    return keep


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, start, stop, key): repeats, joined to runs, have no key; strings of a spread
    anchor have theirs. Shards have about ``limit`` bytes."""

    def sharded(rows: list[tuple], spread: bool) -> Iterator[pa.RecordBatch]:
        if not spread:
            rows = [r for r, k in zip(rows, may_repeat(rows).tolist(), strict=True) if k]
        if not rows:
            return
        doc, start = np.array([r[2] for r in rows]), np.array([r[3] - r[4] for r in rows])
        d, s, g = repeated([r[1] for r in rows], doc, start, spread)
        if not len(d):
            return
        head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        lead = head[np.searchsorted(head, np.arange(len(g)), "right") - 1]
        late = (d != d[lead]) | (s != s[lead])
        yield _runs(d[late], s[late])
        if spread:
            # The first of each group stands for its string in the merge of the anchor's shards.
            # Parts at the start of a document begin alike; the longest holds the others.
            texts: dict[tuple[int, int], bytes] = {}
            for r, begin in zip(rows, start.tolist(), strict=True):
                texts[r[2], begin] = max(texts.get((r[2], begin), b""), r[1], key=len)
            own = sorted(texts)
            keys = []
            for a, b in zip(d[head].tolist(), s[head].tolist(), strict=True):
                k = _holder(own, texts, a, b)
                begin, text = own[k][1], texts[own[k]]
                keys.append(int.from_bytes(hashlib.blake2b(text[b - begin : b - begin + LENGTH], digest_size=8).digest(), "little", signed=True))
            yield _starts(d[head], s[head], np.array(keys, np.int64))

    held: list[tuple] = []
    size = 0
    anchor, spread = None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= limit:
                if row[0] != anchor:
                    yield from sharded(held, spread)
                    held, size, spread = [], 0, False
                elif held[0][0] != anchor:
                    # A shard ends before an anchor that doesn't fit; the next begins with it.
                    own = [r for r in held if r[0] == anchor]
                    yield from sharded([r for r in held if r[0] != anchor], spread)
                    held, size, spread = own, sum(len(r[1]) for r in own), False
                if held and size >= limit:
                    yield from sharded(held, True)
                    held, size, spread = [], 0, True
            if spread and row[0] != anchor:
                if held:
                    yield from sharded(held, True)
                held, size, spread = [], 0, False
            anchor = row[0]
            held.append(row)
            size += len(row[1])
    if held:
        yield from sharded(held, spread)


def _holder(own: list[tuple[int, int]], texts: dict, doc: int, at: int) -> int:
    """The part, by binary search, that holds the string of a document at a place."""
    # Parts that begin later end no earlier, so the last one that begins at the string or before it holds it.
    k = bisect.bisect_right(own, (doc, at)) - 1
    if k < 0 or own[k][0] != doc or own[k][1] + len(texts[own[k]]) < at + LENGTH:
        raise ValueError(f"no part holds the string at {at} of document {doc}")
    return k


STARTS = "doc_id long, start long, stop long, key long"


def _starts(doc: np.ndarray, start: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in (doc, start, start + LENGTH, key)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "stop", "key"])


def _runs(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Strings that begin one byte after another, as one run of bytes."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    turn = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)]) if len(doc) else np.zeros(0, np.int64)
    last = np.append(turn[1:] - 1, len(doc) - 1)[: len(turn)]
    columns = [pa.array(c, pa.int64()) for c in (doc[turn], start[turn], start[last] + LENGTH)]
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(turn), pa.int64())], ["doc_id", "start", "stop", "key"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of several shards: those that another shard has earlier, found by binary search."""
    arrived = [b for b in batches if b.num_rows]
    if arrived:
        held = pa.Table.from_batches(arrived)
        doc, start, key = (held.column(c).to_numpy() for c in ("doc_id", "start", "key"))
        order = np.lexsort((start, doc, key))
        first = order[np.searchsorted(key[order], key, "left")]
        late = (doc[first] != doc) | (start[first] != start)
        yield _runs(doc[late], start[late])


PLACED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, covered array<struct<a:bigint,b:bigint>>, ah long, around binary, pos long, lo int"


def joined(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs that (start, end) rows in any order cover."""
    if not len(runs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    turn = np.flatnonzero(np.r_[True, runs[1:, 0] > reach[:-1]])
    return runs[turn, 0], reach[np.append(turn[1:] - 1, len(runs) - 1)]


def cut(text: bytes, runs: np.ndarray) -> tuple[int, int, str]:
    """Removed bytes, removed runs and hash of the rest, for (start, end) rows in any order."""
    if not len(runs):
        return 0, 0, hashlib.sha256(text).hexdigest()
    a, b = joined(runs)
    digest, at = hashlib.sha256(), 0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        digest.update(text[at:x])
        at = y
    digest.update(text[at:])
    return int((b - a).sum()), len(a), digest.hexdigest()


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())]
        + [("covered", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("ah", pa.int64()), ("around", pa.binary()), ("pos", pa.int64()), ("lo", pa.int32())]
    )

    def filled(columns: dict, size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            sizes = np.array(part.column("marks").value_lengths().fill_null(0).to_pylist())
            ends = np.cumsum(sizes)
            flat = part.column("marks").flatten()
            pos, ah, left, right, covered = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "ah", "lo", "hi", "covered"))
            whole = covered & (left + right >= LENGTH)
            done, pending, open_ = [], [], []
            for doc, text, a, b in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), ends - sizes, ends, strict=True):
                raw = (text or "").encode()
                at = a + np.flatnonzero(whole[a:b])
                runs = np.stack((pos[at] - left[at], pos[at] + right[at]), axis=1)
                rest = a + np.flatnonzero(~covered[a:b])
                if len(rest):
                    pending.append((doc, len(raw), text, [{"a": x, "b": y} for x, y in zip(*(c.tolist() for c in joined(runs)), strict=True)]))
                    begin, stop = (pos[rest] - left[rest]).tolist(), (pos[rest] + right[rest]).tolist()
                    open_ += [(doc, raw[x:y], k) for x, y, k in zip(begin, stop, rest.tolist(), strict=True)]
                else:
                    done.append((doc, len(raw), *cut(raw, runs)))
            if done:
                yield filled(dict(zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), zip(*done, strict=True), strict=True)), len(done))
            if pending:
                yield filled(dict(zip(("doc_id", "n_bytes", "text", "covered"), zip(*pending, strict=True), strict=True)), len(pending))
                ids, around, k = zip(*open_, strict=True)
                at = np.array(k)
                yield filled({"doc_id": ids, "ah": ah[at], "around": around, "pos": pos[at], "lo": left[at]}, len(open_))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            out = []
            for r in batch.slice(lo, 200).to_pylist():
                raw = r["text"].encode()
                runs = [(c["a"], c["b"]) for c in r["covered"]] + [(c["start"], c["stop"]) for c in r["runs"] or []]
                out.append((r["doc_id"], len(raw), *cut(raw, np.array(runs, np.int64).reshape(-1, 2))))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of 100 bytes that covers it also
    starts earlier, in a document of a smaller id or earlier in its own; strings are judged on the
    input and never cross documents. Repeated rows of one id and text are one document and each gets
    its result; unlike texts of one id are documents in the order of their hashes. A row without an id
    neither removes nor loses anything. Texts of any length are looked at whole. Only ``doc_id`` and
    ``text`` are used; an empty table gives an empty one.
    """
    repeated = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long")).count().where("count > 1")
    if repeated.isEmpty():
        return _remove_repeats(docs)
    # Each (id, text) has a number in the order of documents: partitions of a sort are ranges in order.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    ordered = docs.where("doc_id is not null").select("doc_id", "hash").distinct().orderBy("doc_id", "hash")
    numbers = materialise(ordered.withColumn("number", F.monotonically_increasing_id()), "numbers")
    named = docs.join(numbers, ["doc_id", "hash"], "left").select(F.col("number").alias("doc_id"), "text")
    done = _remove_repeats(named).withColumnRenamed("doc_id", "number")
    return done.join(numbers, "number", "left").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _remove_repeats(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    width = shuffle_width(docs.sparkSession)
    found = docs.where("doc_id is not null").mapInArrow(_anchored, ANCHORS).repartition(2 * width, "ah", "own")
    same = Window.partitionBy("ah", "own", "ch").orderBy("doc_id", "pos")
    of_anchor = Window.partitionBy("ah", "own")
    found = found.withColumn("rank", F.rank().over(same)).withColumns({"low": F.min("ch").over(of_anchor), "high": F.max("ch").over(of_anchor)})
    covered = F.col("own").isNotNull() | (F.col("rank") > 1)
    marks = found.where(covered | F.expr("low <> high")).select("doc_id", F.struct("pos", "ah", "lo", "hi", covered.alias("covered")).alias("mark"))
    marks = materialise(marks.distinct(), "anchors").groupBy("doc_id").agg(F.collect_list("mark").alias("marks"))
    placed = materialise(docs.join(marks, "doc_id", "left").mapInArrow(_place, PLACED), "placed")
    around = placed.where("around is not null").select("ah", "around", "doc_id", "pos", "lo").distinct()
    shards = around.repartition(2 * width, "ah").sortWithinPartitions("ah", "doc_id", "pos")
    starts = materialise(shards.mapInArrow(partial(_shards, limit=SHARD_BYTES), STARTS), "repeats")
    across = starts.where("key is not null").repartition(width, "key").mapInArrow(_merged, STARTS)
    late = starts.where("key is null").union(across).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    pending = placed.where("text is not null").select("doc_id", "text", "covered").join(late, "doc_id", "left")
    done = placed.where("kept_sha256 is not null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return done.union(pending.mapInArrow(_finish, RESULT))
