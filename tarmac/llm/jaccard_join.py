"""Exact similarity self-join of documents as sets of word n-grams, and its classes.

The universe of n-gram hashes is cut into segments; two sets that differ in at most H elements must
agree on one of H + 1 segments (pigeonhole). A segment of "one deletion" that agrees up to one
element counts twice. How many segments are of either kind is chosen for each band of set sizes by
the cost of their signatures against that of chance meetings at the number of sets in the band.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .common import materialise, shuffle_width
from .graph import components

BAND_RATIO = 1.3
# What a pair met by chance costs, in signatures.
PAIR_COST = 0.05
# Bits of the filter of wanted sets; 2 MB whatever the input.
FILTER_BITS = 1 << 24

# Bits of the parity sketch that tells most unlike sets apart without their elements.
SKETCH_BITS = 1024
SKETCH = [f"p{k}" for k in range(SKETCH_BITS // 64)]
# Sets of each signature that all others are compared with first.
LEADERS = 4

SET_SCHEMA = "doc_id long, n_shingles long, sid long, " + ", ".join(f"{p} long" for p in SKETCH)
# Of a signature's set: its size, the band, and how many of its signatures may be left out.
SIGN_SCHEMA = "sig long, sid long, n int, band short, spare short"


def band_of(n: np.ndarray) -> np.ndarray:
    """The size band of a set of ``n`` elements."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(BAND_RATIO) + 1e-9).astype(np.int64)


def band_top(band: int) -> int:
    """The largest size of a band."""
    top = int(math.exp((band + 1) * math.log(BAND_RATIO)))
    while band_of(np.array([top]))[0] > band:
        top -= 1
    while band_of(np.array([top + 1]))[0] <= band:
        top += 1
    return top


def most_apart(a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """The most elements in which sets of sizes ``a`` and ``b`` differ if 100 * I >= percent * U."""
    return ((100 - percent) * (a + b)) // (100 + percent)


def spare_of(size: int) -> int:
    """How many segments more than needed a band has: similar sets then agree on that many more.

    Each set may leave out so many of its most frequent signatures, which are those that unrelated
    sets share: empty segments and pieces of common passages.
    """
    return 2 + min(6, size // 40)


def allocate(sets_by_band: dict[int, int], percent: int) -> dict[int, tuple[int, int]]:
    """For each band the numbers of (exact, one-deletion) segments with the least cost.

    An exact segment costs one signature, a one-deletion segment one for each of its elements and
    itself. Segments of either kind meet by chance when they are empty in both sets.
    """
    plan = {}
    for band, count in sets_by_band.items():
        size = band_top(band)
        need = int(most_apart(size, size, percent)) + 1
        best = None
        for wide in sorted({0, need // 4, need // 2, (need + 1) // 2}):
            exact = max(0, need - 2 * wide)
            units = exact + 2 * wide
            load = size / units
            chance = exact * math.exp(-2 * load) + wide * math.exp(-4 * load) * (1 + 2 * load)
            cost = exact + wide * (1 + 2 * load) + PAIR_COST * count * chance
            if best is None or cost < best[0]:
                best = (cost, exact, wide)
        _, exact, wide = best
        plan[band] = (exact + spare_of(size) if exact else 0, wide)
    return plan


def _bands_of_sets(n: np.ndarray, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(position, band) of every set with each band in which the larger set of a pair may lie."""
    own = band_of(n)
    last = band_of(n * 100 // percent)
    out = []
    for step in range(int((last - own).max(initial=0)) + 1):
        at = np.flatnonzero(own + step <= last)
        out.append((at, own[at] + step))
    return out


def sign(n: np.ndarray, value: np.ndarray, plan: dict[int, tuple[int, int]], percent: int) -> list[np.ndarray]:
    """Row, signature, band and spare signatures of all sets; ``value`` are their elements in turn."""
    first = np.concatenate(([0], np.cumsum(n)))
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int16)], [np.zeros(0, np.int16)]]
    full = np.flatnonzero(n > 0)
    for at, bands in _bands_of_sets(n[full], percent):
        at = full[at]
        for band in np.unique(bands):
            if int(band) not in plan:
                continue
            exact, wide = plan[int(band)]
            docs = at[bands == band]
            size = n[docs]
            # The largest partner whose pair belongs to this band.
            partner = np.minimum(band_top(int(band)), size * 100 // percent)
            apart = most_apart(size, partner, percent)
            _segments(docs, size, apart, first, value, exact, wide, int(band), out)
    return [np.concatenate(o) for o in out]


def _segments(docs, size, apart, first, value, exact, wide, band, out) -> None:
    def emit(at, sigs, spare):
        for held, values in zip(out, (docs[at], sigs, np.full(len(at), band, np.int16), np.full(len(at), spare, np.int16)), strict=True):
            held.append(values)

    total = int(size.sum())
    doc = np.repeat(np.arange(len(docs)), size)
    within = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    element = value[first[docs][doc] + within]
    # A wide segment takes two shares of the universe.
    parts = exact + wide
    share = ((element >> np.uint64(32)) % np.uint64(exact + 2 * wide)).astype(np.int64)
    segment = np.where(share < exact, share, exact + (share - exact) // 2)
    cell = doc * parts + segment
    fresh = tx.mix(element ^ np.uint64(0x5DEECE66D))
    sums = np.zeros(len(docs) * parts, np.uint64)
    np.add.at(sums, cell, fresh)
    held = np.bincount(cell, minlength=len(sums))
    place = np.tile(np.arange(parts, dtype=np.uint64), len(docs))
    label = tx.mix(place + np.uint64(band * 1_000_003 + 17))
    mark = tx.mix(sums + label)
    kind = np.tile(np.arange(parts) < exact, len(docs))
    if exact:
        # Fullest segments first, then by content: both sets of a pair order what they share alike.
        order_key = np.where(held > 254, 0, 255 - np.minimum(held, 255)).astype(np.uint64) << np.uint64(56) | mark >> np.uint64(8)
        grid = order_key.reshape(len(docs), parts)[:, :exact]
        order = np.argsort(grid, axis=1, kind="stable")
        # The first H + 1 + spare of them: similar sets share spare + 1 of these, or a wide segment.
        spare = spare_of(band_top(band))
        need = apart - 2 * wide + 1
        keep = np.where(need > 0, np.minimum(need + spare, exact), 0)
        taken = np.arange(exact)[None, :] < keep[:, None]
        where_doc, where_rank = np.nonzero(taken)
        emit(where_doc, mark.reshape(len(docs), parts)[where_doc, order[where_doc, where_rank]], spare)
    if wide:
        own = np.flatnonzero(~kind)
        emit(own // parts, mark[own], 0)
        less = np.flatnonzero(segment >= exact)
        emit(doc[less], tx.mix(sums[cell[less]] - fresh[less] + label[cell[less]]), 0)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, set sizes, elements with their rows, and set ids, chunk by chunk."""
    for lo, hi, raw, offsets in tx.chunks(batch.column("text")):
        _, _, rows, hashes = tx.words(raw, offsets, lower=True)
        row, value = tx.shingles(hashes, rows, hi - lo, size)
        n = np.bincount(row, minlength=hi - lo).astype(np.int64)
        sums = np.zeros(hi - lo, np.uint64)
        np.add.at(sums, row, tx.mix(value))
        yield np.arange(lo, hi), n, row, value, tx.mix(sums + tx.mix(n.astype(np.uint64)))


def _describe(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, n, row, value, sid in _sets(batch, size):
            sketch = [pa.array(c) for c in _sketch(row, value, len(n))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at[0], len(at)), pa.array(n), pa.array(sid.view(np.int64)), *sketch], ["doc_id", "n_shingles", "sid", *SKETCH])


def _sketch(row: np.ndarray, value: np.ndarray, n_rows: int) -> np.ndarray:
    """For each set ``SKETCH_BITS`` bits, each the parity of the elements that fall on it, by word.

    Sets that differ in d elements differ in at most d of these bits.
    """
    slot = tx.mix(value + np.uint64(99)) & np.uint64(SKETCH_BITS - 1)
    out = np.zeros(n_rows * len(SKETCH), np.uint64)
    np.bitwise_xor.at(out, row * len(SKETCH) + (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    return out.view(np.int64).reshape(n_rows, len(SKETCH)).T.copy()


def _signed(batches: Iterator[pa.RecordBatch], size: int, plan: dict[int, tuple[int, int]], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, n, _, value, sid in _sets(batch, size):
            at, sig, band, spare = sign(n, value, plan, percent)
            columns = [sig.view(np.int64), sid[at].view(np.int64), n[at].astype(np.int32), band, spare]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "sid", "n", "band", "spare"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, sid) those of signatures with two sets or more, each set once.

    Only one row is carried from batch to batch, so a signature may have any number of sets.
    """
    carried: list | None = None  # the last row, unless it has gone out
    last: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if carried is not None:
            columns = [np.concatenate((np.asarray([x], c.dtype), c)) for x, c in zip(carried, columns, strict=True)]
        sig, sid = columns[:2]
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])
        if carried is None and last is not None:
            fresh[0] = (sig[0], sid[0]) != last
        columns = [c[fresh] for c in columns]
        before, sig = last, columns[0]
        if not len(sig):
            continue
        same = sig[1:] == sig[:-1]
        multi = np.zeros(len(sig), bool)
        multi[1:] |= same
        multi[:-1] |= same
        if carried is None and before is not None and sig[0] == before[0]:
            multi[0] = True
        last = (sig[-1], columns[1][-1])
        carried = None if multi[-1] else [c[-1] for c in columns]
        if multi.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[multi]) for c in columns], ["sig", "sid", "n", "band", "spare"])


def _wanted(batches: Iterator[pa.RecordBatch], size: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, n, row, value, sid in _sets(batch, size):
            slot = tx.mix(sid) & np.uint64(FILTER_BITS - 1)
            hit = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
            for first in range(0, len(n), 256):
                pick = np.flatnonzero(hit[first : first + 256]) + first
                if not len(pick):
                    continue
                chosen = np.isin(row, pick)
                offsets = np.concatenate(([0], np.cumsum(n[pick]))).astype(np.int32)
                elements = pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[chosen].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(sid[pick].view(np.int64)), elements], ["sid", "elements"])


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = tx.mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(FILTER_BITS - 1)
        yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (slot & np.uint64(63))).view(np.int64))], ["word", "bits"])


def _filter_of(sids: DataFrame) -> np.ndarray:
    """A filter of fixed size (``FILTER_BITS``) of the given set ids; false hits only cost a shuffle."""
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    rows = sids.mapInArrow(_slots, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    for word, mask in rows.toLocalIterator():
        bits[word] = np.uint64(mask & 0xFFFFFFFFFFFFFFFF)
    return bits


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches let two rows (struct columns) be similar; false means they aren't."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    fits = 100 * F.least(x, y) >= percent * F.greatest(x, y)
    apart = reduce(lambda m, n: m + n, [F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in SKETCH])
    return fits & (apart * (100 + percent) <= (100 - percent) * (x + y))


def _verify(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of set ids that are similar, judged on their whole sets."""
    sids = pairs.select(F.col("a").alias("sid")).union(pairs.select("b"))
    bits = _filter_of(sids)
    sets = docs.mapInArrow(partial(_wanted, size=size, bits=bits), "sid long, elements array<long>")
    sets = sets.join(sids.distinct(), "sid", "left_semi").dropDuplicates(["sid"])
    right = pairs.join(sets.select(F.col("sid").alias("b"), F.col("elements").alias("right")), "b")
    both = right.join(sets.select(F.col("sid").alias("a"), F.col("elements").alias("left")), "a")
    met = F.size(F.array_intersect("left", "right"))
    return both.where(100 * met >= percent * (F.size("left") + F.size("right") - met)).select("a", "b")


def similar_classes(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are not looked at. Words are runs
    without white space, with A-Z lowered; a document is the set of its distinct ``size``-word
    shingles, or its whole sequence when it has fewer words. Two documents link when
    ``100 * |both| >= percent * |either|``; ``component_id`` is the smallest id that links reach.

    Null or empty texts have no shingle and link with nothing. Repeated rows stay repeated rows of
    one class. A row without an id keeps its count and has the class of its set if a copy with an id
    exists, else null. An empty table gives an empty one. Equal sets are one node from the start, so
    copies cost one row each. Elements are 64-bit hashes of the words.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = materialise(docs.mapInArrow(partial(_describe, size=size), SET_SCHEMA), "sets")
    # How many sets each band of sizes has: at most some eighty rows.
    width = math.log(BAND_RATIO)
    bands = known.where("n_shingles > 0").groupBy(F.floor(F.log("n_shingles") / width + 1e-9).alias("band")).count()
    counts = {int(r.band): int(r["count"]) for r in bands.collect()}
    for band in list(counts):
        counts.setdefault(band + 1, counts[band])
    plan = allocate(counts, percent)
    signed = docs.mapInArrow(partial(_signed, size=size, plan=plan, percent=percent), SIGN_SCHEMA)
    ordered = signed.repartition(2 * shuffle_width(docs.sparkSession), "sig").sortWithinPartitions("sig", "sid")
    shared = materialise(ordered.mapInArrow(_shared, SIGN_SCHEMA), "shared")
    # Every set leaves out its most frequent signatures; similar sets still meet in a rarer one.
    often = shared.groupBy("sig").count()
    by_set = Window.partitionBy("sid", "band", "spare").orderBy(F.desc("count"), "sig")
    ranked = shared.join(often, "sig").withColumn("rank", F.row_number().over(by_set))
    kept = materialise(ranked.where("rank > spare").select("sig", "sid", "n"), "kept")
    marks = known.join(kept.select("sid").distinct(), "sid", "left_semi").dropDuplicates(["sid"])
    marks = materialise(marks.select("sid", F.struct(F.col("n_shingles").alias("n"), *SKETCH).alias("mark")), "marks")
    # First each set against a few sets of each of its signatures.
    orders = [F.min_by("sid", F.xxhash64("sid", F.lit(k))) for k in range(LEADERS)]
    first = kept.groupBy("sig").agg(F.array_distinct(F.array(*orders)).alias("leads"))
    stars = kept.join(first, "sig").select("sid", F.explode("leads").alias("lead")).where("sid <> lead")
    stars = stars.select(F.least("sid", "lead").alias("a"), F.greatest("sid", "lead").alias("b")).distinct()
    for side in ("a", "b"):
        stars = stars.join(marks.select(F.col("sid").alias(side), F.col("mark").alias(f"mark_{side}")), side)
    tried = materialise(stars.where(_may_link("mark_a", "mark_b", percent)).select("a", "b"), "pairs")
    links = materialise(_verify(docs, tried, size, percent), "links")
    classes = materialise(components(links), "classes")
    # Then signatures whose sets are still of several classes: all pairs across classes that sizes and
    # sketches don't exclude.
    members = kept.join(classes.select(F.col("node").alias("sid"), "component"), "sid", "left")
    members = members.withColumn("component", F.coalesce("component", "sid"))
    open_sigs = members.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    members = members.join(open_sigs.select("sig"), "sig", "left_semi").join(marks, "sid")
    members = materialise(members.select("sig", "sid", "component", "mark"), "open")
    one = members.select("sig", F.col("sid").alias("a"), F.col("component").alias("of_a"), F.col("mark").alias("mark_a"))
    two = members.select("sig", F.col("sid").alias("b"), F.col("component").alias("of_b"), F.col("mark").alias("mark_b"))
    fits = (one.sig == two.sig) & (one.a < two.b) & (one.of_a != two.of_b) & _may_link("mark_a", "mark_b", percent)
    more = materialise(one.join(two, fits).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        late = materialise(_verify(docs, more, size, percent), "links")
        if not late.isEmpty():
            classes = materialise(components(links.union(late)), "classes")
    # Classes of sets to classes of documents.
    nodes = known.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    nodes = nodes.join(classes.select(F.col("node").alias("sid"), "component"), "sid", "left")
    nodes = nodes.select("sid", "first", F.coalesce("component", "sid").alias("component"))
    lowest = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = nodes.join(lowest, "component").select("sid", "component_id")
    empty = F.col("n_shingles") == 0
    return known.join(named, "sid", "left").select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
