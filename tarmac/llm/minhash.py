"""Near duplicates by MinHash bands, with odd sketches that tell unlike candidates apart.

Every distinct set of word shingles has ``BANDS`` * ``ROWS`` MinHash samples. Sets that agree in all
samples of a band are candidates. All samples are also folded into an odd sketch: a bitmap in which
every sample flips one bit. The samples that two sets share cancel out, so the population count of the
XOR of two sketches tells how many they don't share, most precisely at high similarity. The elements
themselves are folded into a second one, whose count is a lower bound of the elements in which two sets
differ and all but exact for small sets. Candidates whose counts are beyond what a similar pair shows
are dropped, the others are judged on their whole sets.

Candidates of a band aren't all paired. Each set is first compared with one leader of each of its
bands, and what is linked becomes one class. Only bands that still hold several classes are looked at
again, and only pairs across classes: first the nearest few for each set and class, then, in bands that
are still open, all that the sketches leave. A large band is cut into blocks; only the sets outside its
largest class visit the other blocks, and a task holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial, reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .common import filter_bits, filter_table, in_filter, materialise, shuffle_width
from .graph import attach, components

# A pair of similarity 0.85 agrees in no band at all with a chance of 6e-13.
BANDS, ROWS = 48, 5
SKETCH_BITS = 512
SKETCH = [f"s{k}" for k in range(SKETCH_BITS // 64)]
# The chance that a linked pair's sketches differ by more than is allowed.
LOST = 1e-9
# The elements' own parities.
PARITY_BITS = 1024
PARITY = [f"p{k}" for k in range(PARITY_BITS // 64)]
# Sets of a block of a band.
BLOCK = 4096
# Pairs that are looked at in one go.
CELLS = 1 << 19
# Partners of a set in another class that are tried first.
NEAREST = 2

_RANDOM = np.random.default_rng(20250511)
_TIMES = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = tx.mix(np.arange(BANDS * ROWS, dtype=np.uint64) + np.uint64(0xC0FFEE))

SET_SCHEMA = "doc_id long, n_shingles long, sid long, bands array<long>, " + ", ".join(f"{s} long" for s in [*SKETCH, *PARITY])


@cache
def most_flipped(percent: int) -> int:
    """The largest population count that a pair of ``percent`` similarity shows but for a chance of ``LOST``.

    Of the samples such a pair doesn't share a binomial number; each flips one bit for either set.
    """
    samples, share = BANDS * ROWS, percent / 100
    ones = np.zeros(SKETCH_BITS + 1)
    ones[0] = 1.0
    total = np.zeros(SKETCH_BITS + 1)
    at = np.arange(SKETCH_BITS + 1) / SKETCH_BITS
    for apart in range(samples + 1):
        total += comb(samples, apart) * (1 - share) ** apart * share ** (samples - apart) * ones
        for _ in range(2):
            flipped = np.zeros(SKETCH_BITS + 1)
            flipped[1:] = (ones * (1 - at))[:-1]
            flipped[:-1] += (ones * at)[1:]
            ones = flipped
    beyond = np.cumsum(total[::-1])[::-1]
    return int(np.flatnonzero(beyond > LOST).max())


def minima(value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The samples, one column each, of the sets of sizes ``n`` whose elements come in turn."""
    out = np.zeros((len(n), BANDS * ROWS), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        first = (np.cumsum(n) - n)[full]
        for k in range(BANDS * ROWS):
            out[full, k] = np.minimum.reduceat(value * _TIMES[k], first)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """For each set ``SKETCH_BITS`` bits, each flipped by the samples that fall on it, by word."""
    slot = tx.mix(samples + _SALT) & np.uint64(SKETCH_BITS - 1)
    out = np.zeros((len(samples), len(SKETCH)), np.uint64)
    row = np.arange(len(samples))
    for k in range(samples.shape[1]):
        out[row, (slot[:, k] >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (slot[:, k] & np.uint64(63))
    return out


def parities(value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each set ``PARITY_BITS`` bits, each flipped by the elements that fall on it, by word.

    Sets that differ in d elements differ in at most d of these bits.
    """
    row = np.repeat(np.arange(len(n)), n)
    slot = tx.mix(value + np.uint64(99)) & np.uint64(PARITY_BITS - 1)
    # Elements of one bit of one set come together; an odd number of them flips it.
    cell, times = np.unique(row * PARITY_BITS + slot.astype(np.int64), return_counts=True)
    cell = cell[times % 2 == 1]
    word = cell >> 6
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(cell) else np.zeros(0, np.int64)
    out = np.zeros(len(n) * len(PARITY), np.uint64)
    if len(cell):
        out[word[starts]] = np.bitwise_or.reduceat(np.uint64(1) << (cell & 63).astype(np.uint64), starts)
    return out.reshape(len(n), len(PARITY))


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One key for each band, unlike between bands."""
    mixed = tx.mix(samples + _SALT).reshape(len(samples), BANDS, ROWS)
    return tx.mix((mixed * tx._PLACE[:ROWS]).sum(axis=2, dtype=np.uint64) + _SALT[:BANDS])


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First and end row, set sizes, elements in turn, and set ids, chunk by chunk."""
    for lo, hi, raw, offsets in tx.chunks(batch.column("text")):
        _, _, rows, hashes = tx.words(raw, offsets, lower=True)
        row, value = tx.shingles(hashes, rows, hi - lo, size)
        n = np.bincount(row, minlength=hi - lo).astype(np.int64)
        sums = np.zeros(hi - lo, np.uint64)
        np.add.at(sums, row, tx.mix(value))
        yield lo, hi, n, value, tx.mix(sums + tx.mix(n.astype(np.uint64))).view(np.int64)


def _described(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, n, value, sid in _sets(batch, size):
            samples = minima(value, n)
            places = pa.array(np.arange(0, (hi - lo + 1) * BANDS, BANDS, dtype=np.int32))
            bands = pa.ListArray.from_arrays(places, pa.array(band_keys(samples).view(np.int64).ravel()))
            sketch = np.hstack((odd_sketch(samples), parities(value, n))).view(np.int64).T.copy()
            columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array(n), pa.array(sid), bands, *[pa.array(c) for c in sketch]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "sid", "bands", *SKETCH, *PARITY])


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches let two sets (struct columns) be similar."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")

    def flipped(words: list[str]) -> Column:
        return reduce(lambda m, n: m + n, [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in words])

    fits = 100 * F.least(x, y) >= percent * F.greatest(x, y)
    return fits & (flipped(SKETCH) <= most_flipped(percent)) & (flipped(PARITY) * (100 + percent) <= (100 - percent) * (x + y))


class Block:
    """The sets at home in one block of a band, and the pairs across classes that they may be part of."""

    def __init__(self, percent: int, most: int | None):
        self.percent, self.most, self.limit = percent, most, most_flipped(percent)
        self.parts: list[dict[str, np.ndarray]] = []
        self.sets: dict[str, np.ndarray] = {}

    def add(self, rows: dict[str, np.ndarray]) -> None:
        self.parts.append(rows)

    def close(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All sets are here: pairs among them. The largest class comes last; its sets aren't compared."""
        sets = {c: np.concatenate([r[c] for r in self.parts]) for c in self.parts[0]}
        _, of, sizes = np.unique(sets["component"], return_inverse=True, return_counts=True)
        order = np.argsort(of == sizes.argmax(), kind="stable")
        self.sets = {c: v[order] for c, v in sets.items()}
        place = np.arange(len(order))
        yield from self._meet(self.sets, place[: len(order) - int(sizes.max())], lambda i: place[None, :] > i[:, None])

    def visit(self, rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets at home in other blocks with those here. Two visitors of each other's blocks meet once."""
        here, home = self.sets["largest"][None, :], self.sets["home"][None, :]
        yield from self._meet(rows, np.arange(len(rows["sid"])), lambda i: here | (rows["home"][i][:, None] < home))

    def _meet(self, rows: dict[str, np.ndarray], which: np.ndarray, allowed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the given rows with the sets here, as many rows at a time as ``CELLS`` allow."""
        sets, p = self.sets, self.percent
        step = max(1, CELLS // len(sets["sid"]))
        for lo in range(0, len(which), step):
            own = which[lo : lo + step]
            n, m = rows["n"][own][:, None], sets["n"][None, :]
            fits = allowed(own) & (rows["component"][own][:, None] != sets["component"][None, :])
            fits &= 100 * np.minimum(n, m) >= p * np.maximum(n, m)
            # Word by word, so that what is held is one number a pair.
            apart = np.zeros(fits.shape, np.uint16)
            for w in range(len(SKETCH)):
                apart += np.bitwise_count(rows["sketch"][own, w][:, None] ^ sets["sketch"][None, :, w])
            i, j = np.nonzero(fits & (apart <= self.limit))
            if not len(i):
                continue
            near, i = apart[i, j], own[i]
            differ = np.bitwise_count(rows["parity"][i] ^ sets["parity"][j]).sum(axis=1, dtype=np.int64)
            good = differ * (100 + p) <= (100 - p) * (rows["n"][i] + sets["n"][j])
            i, j, near = i[good], j[good], near[good]
            if self.most is not None and len(i):
                of = sets["component"][j]
                order = np.lexsort((sets["sid"][j], near, of, i))
                i, j, of = i[order], j[order], of[order]
                first = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (of[1:] != of[:-1])])
                rank = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))
                i, j = i[rank < self.most], j[rank < self.most]
            if len(i):
                yield rows["sid"][i], sets["sid"][j]


def _across(batches: Iterator[pa.RecordBatch], percent: int, most: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs across classes, of rows sorted by band, block and whether they visit it.

    Of each set and other class the ``most`` nearest pairs, or all. Only the sets at home in a block
    are held; visitors pass by.
    """

    def out(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        found = list(pairs)
        if found:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    block, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block", "visit", "sid", "n", "component", "home", "largest")}
        for name, words in (("sketch", SKETCH), ("parity", PARITY)):
            rows[name] = np.stack([batch.column(s).to_numpy().view(np.uint64) for s in words], axis=1)
        turn = [rows[c][1:] != rows[c][:-1] for c in ("key", "block", "visit")]
        edges = np.r_[0, np.flatnonzero(turn[0] | turn[1] | turn[2]) + 1, batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            own = {c: v[lo:hi] for c, v in rows.items()}
            at = (own["key"][0], own["block"][0])
            if at != last:
                if block is not None and not block.sets and block.parts:
                    yield from out(block.close())
                block, last = Block(percent, most), at
            if own["visit"][0]:
                # A block without sets of its own has nobody to visit.
                if not block.sets and block.parts:
                    yield from out(block.close())
                if block.sets:
                    yield from out(block.visit(own))
            else:
                block.add(own)
    if block is not None and not block.sets and block.parts:
        yield from out(block.close())


def _candidates(shared: DataFrame, classes: DataFrame, marks: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Pairs (a, b) of sets of one band and unlike classes that sizes and sketches let be similar."""
    members = shared.select("key", "sid").join(classes.select(F.col("node").alias("sid"), "component"), "sid", "left")
    members = members.withColumn("component", F.coalesce("component", "sid"))
    # Bands of several classes, with their largest one and the number of blocks.
    of_class = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    seen = of_class.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.sum("n").alias("held"), F.count("*").alias("classes"))
    still = seen.where("classes > 1").select("key", "most", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"))
    members = members.join(still, "key").withColumn("home", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    members = members.withColumn("largest", F.col("component") == F.col("most"))
    # Sets outside the largest class go to all blocks.
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = members.withColumn("block", F.explode(F.when(F.col("largest"), F.array("home")).otherwise(everywhere)))
    dealt = dealt.withColumn("visit", F.col("block") != F.col("home")).drop("most", "blocks")
    dealt = dealt.join(marks, "sid").select("key", "block", "visit", "sid", "mark.n", "component", "home", "largest", *[f"mark.{s}" for s in [*SKETCH, *PARITY]])
    dealt = dealt.repartition(2 * shuffle_width(shared.sparkSession), "key", "block").sortWithinPartitions("key", "block", "visit", "sid")
    return dealt.mapInArrow(partial(_across, percent=percent, most=most), "a long, b long").distinct()


def _wanted(batches: Iterator[pa.RecordBatch], size: int, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The elements of the sets that the filter lets pass."""
    for batch in batches:
        for _, _, n, value, sid in _sets(batch, size):
            hit = in_filter(table, sid.view(np.uint64) & np.uint64(len(table) * 64 - 1))
            if hit.any():
                ends = np.concatenate(([0], np.cumsum(n[hit]))).astype(np.int32)
                elements = pa.ListArray.from_arrays(pa.array(ends), pa.array(value[np.repeat(hit, n)].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(sid[hit]), elements], ["sid", "elements"])


def _linked(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of set ids that are similar, judged on their whole sets."""
    sids = materialise(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(), "sids")
    bits = filter_bits(sids.count())
    table = filter_table(sids.select(F.expr(f"sid & {bits - 1}L")), bits)
    sets = docs.mapInArrow(partial(_wanted, size=size, table=table), "sid long, elements array<long>")
    sets = sets.join(sids, "sid", "left_semi").dropDuplicates(["sid"])
    right = pairs.join(sets.select(F.col("sid").alias("b"), F.col("elements").alias("right")), "b")
    both = right.join(sets.select(F.col("sid").alias("a"), F.col("elements").alias("left")), "a")
    met = F.size(F.array_intersect("left", "right"))
    return both.where(100 * met >= percent * (F.size("left") + F.size("right") - met)).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are not looked at. Words are runs
    without white space, with A-Z lowered; a document is the set of its distinct ``size``-word
    shingles, or its whole sequence when it has fewer words. Documents with ``100 * |both| >=
    percent * |either|`` are linked, ``component_id`` is the smallest id that links reach and ``kept``
    whether it is the document's own.

    Null or empty texts have no shingle, link with nothing and are kept. Of repeated rows of a kept id
    all are kept. A row without an id has the class of its set if a copy with an id exists, else null,
    and is never kept. An empty table gives an empty one. Texts are read whole, in a task one at a time if
    they are long. Elements are 64-bit hashes of the words. Links are found but for the chances named
    at ``BANDS`` and ``LOST``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = materialise(docs.mapInArrow(partial(_described, size=size), SET_SCHEMA), "described")
    known = described.select("doc_id", "n_shingles", "sid")
    sets = materialise(described.where("n_shingles > 0").drop("doc_id").dropDuplicates(["sid"]), "sets")
    bands = sets.select("sid", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("held"), F.min_by("sid", F.xxhash64("sid")).alias("lead")).where("held > 1")
    shared = materialise(bands.join(shared.select("key", "lead"), "key"), "shared")
    marks = sets.join(shared.select("sid").distinct(), "sid", "left_semi")
    marks = materialise(marks.select("sid", F.struct(F.col("n_shingles").alias("n"), *SKETCH, *PARITY).alias("mark")), "marks")
    # Each set against one of each of its bands.
    stars = shared.where("sid <> lead").select(F.least("sid", "lead").alias("a"), F.greatest("sid", "lead").alias("b")).distinct()
    for side in ("a", "b"):
        stars = stars.join(marks.select(F.col("sid").alias(side), F.col("mark").alias(f"mark_{side}")), side)
    tried = materialise(stars.where(_may_link("mark_a", "mark_b", percent)).select("a", "b"), "pairs")
    links = materialise(_linked(docs, tried, size, percent), "links")
    classes = materialise(components(links), "classes")
    # Bands whose sets are still of several classes: the nearest pairs across them, then all.
    for most in (NEAREST, None):
        late = _candidates(shared, classes, marks, percent, most).join(tried, ["a", "b"], "left_anti")
        late = materialise(late, "pairs")
        if late.isEmpty():
            continue
        tried = tried.union(late)
        found = materialise(_linked(docs, late, size, percent), "links")
        if not found.isEmpty():
            links = links.union(found)
            classes = materialise(components(links), "classes")
    # From classes of sets to those of documents.
    first = known.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    first = first.join(classes.select(F.col("node").alias("sid"), "component"), "sid", "left")
    first = materialise(first.select("sid", "first", F.coalesce("component", "sid").alias("component")), "firsts")
    lowest = first.groupBy("component").agg(F.min("first").alias("component_id"))
    named = first.join(lowest, "component").select("sid", "component_id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = attach(known, named, "sid").select("doc_id", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
