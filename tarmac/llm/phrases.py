"""Collocations of two and three words, counted by dynamic itemset counting.

The texts are dealt to ``SHARDS`` shards, which are scanned in turn again and again. Single words are
counted in the first cycle. A pair of words is activated when both have reached the threshold in the
shards scanned so far; from the next shard on it is counted for one full cycle, so its count is exact,
and while words are still counted. Phrases of three words follow in the same way once both of their
pairs have reached it. The scans end when no phrase is left in its cycle, after at most three cycles.

When a word or pair was activated is kept by the slot of its hash, in a table of bounded size. Of all
that share a slot the first counts, and a slot never changes once set. A phrase may thus be counted
although it can't be frequent, or start sooner, but each has one start and exactly one cycle.

Counts go through shuffles and files in blocks: the sorted keys of one part of the keys' range, as
differences and byte by byte, which takes some six bytes for each instead of eleven for a row. Texts and
blocks pass between Spark and Python in small batches, and a scan is sent two bits for each slot, so that
neither side holds much more than the phrases it sums at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .common import filter_bits, filter_table, in_filter, materialise, shuffle_width, small_batches

SHARDS = 4
LEAST = 10
TOP = 2000
# Drop a phrase that at least so many percent of the time is part of one and the same longer phrase.
PART = 50
# Phrases of a task that are summed at a time, and bytes of their blocks that are given out at a time.
HELD, GIVEN = 1 << 20, 1 << 20
# Slots for each word or pair that is frequent at first, and their bounds (256 KB and 16 MB).
SLOTS_EACH, FEWEST_SLOTS, MOST_SLOTS = 64, 1 << 18, 1 << 24
NEVER = 255
# Parts into which the candidates of a language are dealt before they are ranked.
SALTS = 32

# What ends a piece, and what ends a word.
_BREAK = np.zeros(256, bool)
_BREAK[[10, 11, 12, 13, *b".,;:!?"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 9]] = True
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Sorted keys of one part of their range and their counts.
BLOCKS = "length int, part int, block binary"
# Parts of the keys' range for each partition of a shuffle.
PARTS_EACH = 4
# Sets the slots of a key apart by the shard in which it is looked for; three times it is a long.
APART = 0x1B873593CC9E2D51
# A phrase, and the keys of the two parts that each of its cuts makes.
SPELLED = "key long, length int, lang string, phrase string, first1 long, rest1 long, first2 long, rest2 long"


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of phrases put together from the keys of their words or parts."""
    return tx.mix(a * np.uint64(3) + tx.mix(b + np.uint64(0x51ED270B)))


@dataclass
class Progress:
    """The step after whose scan words (length 1) and pairs (2) were activated, by slot."""

    shards: int = SHARDS
    since: dict[int, np.ndarray] = field(default_factory=dict)

    def counted(self, activated: np.ndarray, step: int) -> np.ndarray:
        """Whether phrases whose parts were activated then are in their cycle at ``step``."""
        return (activated < step) & (step <= activated + self.shards)

    def since_bits(self, step: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For words and pairs the slots activated before ``step``, and those of them still in their cycle, as filters."""
        return {length: (slot_bits(table < step), slot_bits(self.counted(table.astype(np.int16), step))) for length, table in self.since.items()}

    def reach(self, length: int, keys: DataFrame, step: int) -> bool:
        """Activate the keys (one column) after ``step``; whether any slot was new."""
        if length not in self.since:
            size = FEWEST_SLOTS
            while size < min(SLOTS_EACH * keys.count(), MOST_SLOTS):
                size *= 2
            self.since[length] = np.full(size, NEVER, np.uint8)
        table = self.since[length]
        slots = keys.toDF("key").select(F.expr(f"key & {len(table) - 1}L"))
        bits = np.unpackbits(filter_table(slots, len(table)).view(np.uint8), bitorder="little").astype(bool)
        fresh = bits & (table == NEVER)
        table[fresh] = step
        return bool(fresh.any())


def slot_bits(slots: np.ndarray) -> np.ndarray:
    """A filter with the bits of the slots that are true."""
    return np.packbits(slots, bitorder="little").view(np.uint64)


def in_slots(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the slots of the keys are set."""
    return in_filter(table, keys & np.uint64(len(table) * 64 - 1))


def _active(since: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether what is put together from the keys at ``first`` and the next ones is in its cycle: both were activated, one of them not a cycle ago."""
    if since is None:
        return np.zeros(len(first), bool)
    reached, fresh = (in_slots(table, keys) for table in since)
    return reached[first] & reached[first + 1] & (fresh[first] | fresh[first + 1])


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """For each chunk its bytes, its words' starts, ends, rows and keys, and whether a word's next one follows in its piece."""
    langs = batch.column("lang").dictionary_encode()
    raw, offsets = tx.text_buffers(langs.dictionary)
    # Mixed once more, since a language may have the name of a word.
    of_lang = tx.mix(tx.span_hashes(raw, offsets[:-1], offsets[1:]) ^ np.uint64(0x1F123BB5))[langs.indices.to_numpy(zero_copy_only=False)]
    for lo, _, raw, offsets in tx.chunks(batch.column("text")):
        starts, ends, rows = tx.spans(~_GAP[raw], offsets)
        if not len(starts):
            continue
        keys = tx.mix(tx.span_hashes(raw, starts, ends, lower=True) + of_lang[rows + lo])
        piece = np.cumsum(_BREAK[raw])[starts]
        yield raw, starts, ends, rows + lo, keys, (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])


def _phrases(keys: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place and key of all pairs, and place and key of all phrases of three."""
    two = np.flatnonzero(joined)
    pairs = pair_keys(keys[two], keys[two + 1])
    three = np.flatnonzero(two[1:] == two[:-1] + 1)
    return two, pairs, three, pair_keys(pairs[three], keys[two[three] + 2])


def pack(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted keys, as the first and differences, and their counts, byte by byte from the lowest, without the high ones that are all zero."""
    head, planes = keys[:1].tobytes(), []
    for column in (np.diff(keys, prepend=keys[:1]), n.astype(np.uint64)):
        width = (int(column.max()).bit_length() + 7) // 8
        head += bytes([width])
        planes.append(column.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return head + b"".join(planes)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    widths, at, columns = block[8:10], 10, []
    size = (len(block) - at) // sum(widths)
    for width in widths:
        column = np.zeros((size, 8), np.uint8)
        column[:, :width] = np.frombuffer(block, np.uint8, width * size, at).reshape(width, size).T
        columns.append(column.view(np.uint64)[:, 0])
        at += width * size
    columns[0][0] = np.frombuffer(block, np.uint64, 1)[0]
    return np.cumsum(columns[0]), columns[1]


def part_bits(width: int) -> int:
    """Leading bits of a key that tell its part."""
    return (PARTS_EACH * width - 1).bit_length()


class Sums:
    """Counts of keys by length, given out in blocks whenever ``HELD`` keys of a length have come."""

    def __init__(self, bits: int):
        self.bits = bits
        self.held: dict[int, list[np.ndarray]] = {1: [], 2: [], 3: []}
        self.size = {1: 0, 2: 0, 3: 0}

    def add(self, length: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            self.held[length].append(keys)
            self.size[length] += len(keys)
            if self.size[length] >= HELD:
                yield from self.flush(length)

    def flush(self, length: int) -> Iterator[pa.RecordBatch]:
        if self.held[length]:
            keys = np.concatenate(self.held[length])
            self.held[length], self.size[length] = [], 0
            keys.sort()
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            n = np.diff(first, append=len(keys))
            keys = keys[first]
            parts = (keys >> np.uint64(64 - self.bits)).astype(np.int32)
            first = np.flatnonzero(np.diff(parts, prepend=-1))
            blocks, size, given = [], 0, 0
            for k, (lo, hi) in enumerate(zip(first, [*first[1:], len(keys)], strict=True), 1):
                blocks.append(pack(keys[lo:hi], n[lo:hi]))
                size += len(blocks[-1])
                if size >= GIVEN or k == len(first):
                    columns = [pa.array(np.full(len(blocks), length, np.int32)), pa.array(parts[first[given:k]]), pa.array(blocks, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["length", "part", "block"])
                    blocks, size, given = [], 0, k


def _one_block(blocks: list[bytes]) -> bytes:
    """The blocks of a part as one."""
    got = [unpack(b) for b in blocks]
    keys, n = np.concatenate([k for k, _ in got]), np.concatenate([c for _, c in got])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return pack(keys[first], np.add.reduceat(n[order], first))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block for each length and part; rows come in their order."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("length", "part", "block")), strict=True))
    for (length, part), own in groupby(rows, key=lambda row: row[:2]):
        block = _one_block([row[2] for row in own])
        yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([part], pa.int32()), pa.array([block], pa.binary())], ["length", "part", "block"])


def _rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _often(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Length and key of what comes ``share`` times or more in a block."""
    for batch in batches:
        for length, block in zip(batch.column("length").to_pylist(), batch.column("block").to_pylist(), strict=True):
            keys, n = unpack(block)
            keys = keys[n >= share]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), length, np.int32)), pa.array(keys.view(np.int64))], ["length", "key"])


def _scan(batches: Iterator[pa.RecordBatch], words: bool, since: dict[int, tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    """Counts of the words, if they are still counted, and of the phrases that are in their cycle."""
    sums = Sums(bits)
    for batch in batches:
        for _, _, _, _, keys, joined in _chunks(batch):
            if words:
                yield from sums.add(1, keys)
            if 1 not in since:
                continue
            two, pairs, three, triples = _phrases(keys, joined)
            yield from sums.add(2, pairs[_active(since[1], keys, two)])
            yield from sums.add(3, triples[_active(since.get(2), pairs, three)])
    for length in (1, 2, 3):
        yield from sums.flush(length)


def _may_be(batches: Iterator[pa.RecordBatch], table: np.ndarray | None, known: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Key and count of what the filter lets pass, without those whose slot is set in ``known``."""
    for batch in batches:
        for block in batch.column("block").to_pylist():
            keys, n = unpack(block)
            good = np.ones(len(keys), bool) if table is None else in_slots(table, keys)
            if known is not None:
                good &= ~in_slots(known, keys)
            yield _rows(keys[good], n[good])


class Counts:
    """The counts of all scans so far."""

    def __init__(self, least: int):
        self.least = least
        self.scans: list[DataFrame] = []
        self.often: list[DataFrame] = []

    def add(self, made: DataFrame, shard: int) -> None:
        order = ["length", "part"]
        scan = materialise(made.repartition(*order).sortWithinPartitions(*order).mapInArrow(_summed, BLOCKS), "counts")
        self.scans.append(scan)
        # A frequent phrase has its share of the threshold in one of the shards of its cycle.
        share = -(-self.least // SHARDS)
        often = scan.where("length > 1").mapInArrow(partial(_often, share=share), "length int, key long")
        self.often.append(materialise(often.withColumn("shard", F.lit(shard)), "often"))

    def oftenest(self, length: int) -> DataFrame:
        """(key, shard) of the pairs or longer phrases that come often in a shard."""
        return reduce(DataFrame.union, self.often).where(F.col("length") == length).select("key", "shard")

    def frequent(self, length: int, known: np.ndarray | None = None) -> DataFrame:
        """(key, n) of the phrases of a length that come ``least`` times or more in all scans.

        Of pairs and longer phrases only keys that come often in one shard, by a filter of bounded size,
        are summed up. None whose slot is set in ``known`` is.
        """
        own = reduce(DataFrame.union, self.scans).where(F.col("length") == length).select("block")
        table = None
        if length > 1:
            often = self.oftenest(length).select("key").coalesce(shuffle_width(own.sparkSession))
            bits = filter_bits(4 * often.count())
            table = filter_table(often.select(F.expr(f"key & {bits - 1}L")), bits)
        own = own.mapInArrow(partial(_may_be, table=table, known=known), "key long, n long")
        return own.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= self.least)


def count_phrases(texts: DataFrame, least: int = LEAST) -> dict[int, DataFrame]:
    """For lengths 1 to 3 the (key, n) of all phrases that come ``least`` times or more.

    Those of two or three words have a ``shard`` as well, in which they occur. ``texts`` has lang, text and shard (0 to ``SHARDS`` - 1).
    """
    progress, counts = Progress(), Counts(least)
    # The last step whose scan still meets phrases in their cycle.
    step, last = 0, SHARDS - 1
    bits = part_bits(shuffle_width(texts.sparkSession))
    while step <= last:
        scanned = texts.where(F.col("shard") == step % SHARDS).select("lang", "text")
        counts.add(scanned.mapInArrow(partial(_scan, words=step < SHARDS, since=progress.since_bits(step), bits=bits), BLOCKS), step % SHARDS)
        # Words are all counted after the first cycle, pairs after the second.
        for length in (1, 2):
            if step < length * SHARDS and (length == 1 or step):
                known = progress.since.get(length)
                fresh = counts.frequent(length, None if known is None else slot_bits(known != NEVER))
                if progress.reach(length, materialise(fresh.select("key"), "reached"), step):
                    last = max(last, step + SHARDS)
        step += 1
    made = {1: materialise(counts.frequent(1), "frequent1")}
    for length in (2, 3):
        where = counts.oftenest(length).groupBy("key").agg(F.min("shard").alias("shard"))
        made[length] = materialise(counts.frequent(length).join(where, "key"), f"frequent{length}")
    return made


def _spelled(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Language, words and parts of the phrases that the filter lets pass in their shard, each mostly once a task."""
    seen = np.zeros(1 << 18, np.uint64)
    for batch in batches:
        apart = batch.column("shard").to_numpy().astype(np.uint64) * np.uint64(APART)
        for raw, starts, ends, rows, keys, joined in _chunks(batch):
            two, pairs, three, triples = _phrases(keys, joined)
            none = np.zeros(len(two), np.uint64)
            found = [(2, two, pairs, keys[two], keys[two + 1], none, none)]
            found.append((3, two[three], triples, keys[two[three]], pairs[three + 1], pairs[three], keys[two[three] + 2]))
            lower = None
            for length, at, key, *parts in found:
                slot = (tx.mix(key) & np.uint64(len(seen) - 1)).astype(np.int64)
                pick = np.flatnonzero(in_filter(table, (key ^ apart[rows[at]]) & np.uint64(len(table) * 64 - 1)) & (seen[slot] != key))
                if not len(pick):
                    continue
                _, first = np.unique(key[pick], return_index=True)
                pick = pick[first]
                seen[slot[pick]] = key[pick]
                lower = _LOWER[raw].tobytes() if lower is None else lower
                said = [" ".join(lower[starts[p] : ends[p]].decode() for p in range(k, k + length)) for k in at[pick].tolist()]
                columns = [pa.array(key[pick].view(np.int64)), pa.array(np.full(len(pick), length, np.int32)), batch.column("lang").take(pa.array(rows[at[pick]]))]
                columns += [pa.array(said, pa.string())] + [pa.array(p[pick].view(np.int64)) for p in parts]
                yield pa.RecordBatch.from_arrays(columns, ["key", "length", "lang", "phrase", "first1", "rest1", "first2", "rest2"])


def _scored(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """``phrases`` with l, r and score of the cut that scores lowest; of equals the first."""
    for name in ("first1", "rest1", "first2", "rest2"):
        phrases = phrases.join(parts.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}")), name, "left")
    # Products of whole numbers up to 38 digits; the quotient is a million at most.
    whole = {c: f"cast({c} as decimal(15,0))" for c in ("a", "n_first1", "n_rest1", "n_first2", "n_rest2")}

    def score(k: int) -> str:
        return f"cast((cast(1000000 as decimal(7,0)) * {whole['a']} * {whole['a']}) div ({whole[f'n_first{k}']} * {whole[f'n_rest{k}']}) as bigint)"

    cut = [f"named_struct('score', {score(k)}, 'k', {k}, 'l', n_first{k}, 'r', n_rest{k})" for k in (1, 2)]
    best = F.expr(f"case when length = 2 then {cut[0]} else least({cut[0]}, {cut[1]}) end")
    return phrases.withColumn("cut", best).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` needs ``text`` and ``lang``; other columns are not looked at. A-Z are lowered, texts are
    split into pieces at ``[.,;:!?]`` and line ends, and these into words at blanks and tabs. Candidates
    are the phrases of two or three words that come ``a >= least`` times in a language (overlaps
    included), but for those that lie in one longer candidate in half their places or more. A cut in
    two parts that come l and r times scores floor(10**6 * a * a / (l * r)); the lowest cut counts, of
    equals the first. Order is by score and a, falling, then by the phrase's bytes.

    A null language is ``und``; null and empty texts have no words. Repeated rows count as often as they
    come. Texts of any length are read whole. Languages without a candidate, and empty tables, have no
    rows. Words and phrases are told apart by 64-bit hashes.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    texts = docs.withColumn("shard", F.pmod(F.xxhash64("lang", "text"), F.lit(SHARDS)))
    with small_batches(docs.sparkSession):
        counts = count_phrases(texts, least)
        candidates = counts[2].withColumn("length", F.lit(2)).union(counts[3].withColumn("length", F.lit(3)))
        bits = filter_bits(8 * candidates.count())
        # A phrase is spelled by the texts of one shard that has it.
        table = filter_table(candidates.select(F.expr(f"(key ^ (shard * {APART}L)) & {bits - 1}L")), bits)
        said = texts.select("lang", "text", F.col("shard").cast("int").alias("shard")).mapInArrow(partial(_spelled, table=table), SPELLED).dropDuplicates(["key"])
        named = materialise(candidates.select("key", F.col("n").alias("a")).join(said, "key"), "candidates")
    # Pairs within a phrase of three that comes half as often or more; the most frequent one decides.
    longer = named.where("length = 3").select("a", F.explode(F.array("first2", "rest1")).alias("key")).groupBy("key").agg(F.max("a").alias("most"))
    kept = named.join(longer, "key", "left").where(f"most is null or 100 * most < {PART} * a")
    scored = _scored(kept, counts[1].union(counts[2].select("key", "n")))
    # The first of each part of a language, then of the language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = docs.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(WORD)).cast("long")).alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
