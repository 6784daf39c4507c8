"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares two words by the letter triples that they share in order, with gaps of up to
``SPAN`` letters and each letter of span costing a factor ``DECAY``. Signs between letters don't
count and single letters in a row are one word, so inserted characters and spaced or gapped
spellings stay close to the plain ones. A sentence is described by its greatest similarity to each
landmark, scaled to a length of one at most and mapped by the inverse root of the landmarks' own kernel matrix (Nyström); a linear machine
learns from labelled sentences, and a text has the score of its most toxic sentence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .common import held_out, let, materialise, may_be_in
from .svm import fit_sigmoid, fit_svm, sigmoid

# At most so many labelled rows are learned from, those with the smallest hash of their id.
SAMPLE_ROWS = 8000
LANDMARKS = 128
# Candidates that landmarks are chosen from.
CANDIDATES = 2000
# A landmark is in so many texts.
FEWEST = 3
# Landmarks are less similar to one another than this.
APART = 0.65
# Of all words looked at, about so many would pass as marks of toxic texts by chance.
CHANCE = 0.05
# At most so many different sentences of each label are fitted, those with the smallest hashes.
SAMPLE_SENTENCES = 20000
DECAY = 0.6
SPAN = 5
# Words less similar than this to every landmark are all alike.
LEAST = 0.4
# The kernel is raised to this power (again a kernel), which sets close spellings apart from chance.
POWER = 3
SYMBOLS = 32
SLOTS = 1 << 20
THRESHOLD = 0.3

# Letters are 1 to 26, digits that stand for letters likewise, letters outside ASCII 27 to 31 by their
# last byte, everything else 0.
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
for _digit, _letter in zip("013457", "oieast", strict=True):
    _SYMBOL[ord(_digit)] = ord(_letter) - 96
_SYMBOL[0x80:0xC0] = 27 + np.arange(64) % 5

TRIPLES = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def units(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words, where each word begins in them, its row, and where it begins in the bytes."""
    starts, ends, rows = tx.spans(~tx.SPACE[raw], offsets)
    symbol = _SYMBOL[raw]
    at = np.flatnonzero(symbol)
    stream = symbol[at]
    first = np.searchsorted(at, starts)
    size = np.searchsorted(at, ends) - first
    some = size > 0
    starts, rows, first, size = starts[some], rows[some], first[some], size[some]
    if len(first):
        alone = size == 1
        joined = np.zeros(len(first), bool)
        joined[1:] = alone[1:] & alone[:-1] & (rows[1:] == rows[:-1])
        starts, rows, first = starts[~joined], rows[~joined], first[~joined]
    return stream, first, rows, starts


def _codes(stream: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.float64]]:
    """(unit, code of a triple, weight) for each shape of gaps, over all positions."""
    n = len(stream)
    unit = np.zeros(n, np.int64)
    unit[first[1:]] = 1
    unit = np.cumsum(unit)
    wide = stream.astype(np.int64)
    for a, b in TRIPLES:
        if n <= b:
            continue
        own = np.flatnonzero(unit[:-b] == unit[b:])
        yield unit[own], wide[own] * SYMBOLS * SYMBOLS + wide[own + a] * SYMBOLS + wide[own + b], DECAY ** (b - 2)


def features(words: list[np.ndarray]) -> np.ndarray:
    """Unit-length vectors of weighted triples, one row for each word of symbols."""
    out = np.zeros((len(words), SYMBOLS**3), np.float32)
    for k, w in enumerate(words):
        for _, code, weight in _codes(w, np.zeros(1, np.int64)):
            np.add.at(out[k], code, weight)
    out /= np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-9)[:, None]
    return out


def symbols_of(word: str) -> np.ndarray:
    s = _SYMBOL[np.frombuffer(word.encode(), np.uint8)]
    return s[s > 0]


@dataclass
class Kernel:
    """Landmarks and the table by which a word's similarity to all of them is summed up."""

    words: list[str]
    table: np.ndarray = field(init=False)
    top: np.ndarray = field(init=False)
    root: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        made = features([symbols_of(w) for w in self.words])
        gram = (made @ made.T) ** POWER
        values, vectors = np.linalg.eigh(gram.astype(np.float64))
        self.root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        self.table = np.ascontiguousarray(made.T)
        self.top = made.max(axis=0) if len(self.words) else np.zeros(SYMBOLS**3, np.float32)

    def __reduce__(self) -> tuple:
        # Tasks build the tables from the words; these are a thousandth of their size.
        return Kernel, (self.words,)

    def similarity(self, stream: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, similarities to all landmarks) of the units that are close to one of them."""
        n = len(first)
        bound = np.zeros(n)
        for unit, code, weight in _codes(stream, first):
            bound += np.bincount(unit, weight * self.top[code], minlength=n)
        # The norm of a word is at least that of its triples counted as if all were different.
        size = np.diff(np.append(first, len(stream)))
        square = sum(DECAY ** (2 * (b - 2)) * np.maximum(size - b, 0) for a, b in TRIPLES)
        close = np.flatnonzero(bound >= LEAST * np.sqrt(square) - 1e-9)
        close = close[size[close] >= 3]
        if not len(close):
            return close, np.zeros((0, len(self.words)), np.float32)
        kept = np.concatenate([np.arange(first[c], first[c] + size[c]) for c in close])
        small, begin = stream[kept], np.cumsum(size[close]) - size[close]
        parts = [(u, c, np.full(len(u), w)) for u, c, w in _codes(small, begin)]
        unit, code, weight = (np.concatenate([p[k] for p in parts]) for k in range(3))
        key, back = np.unique(unit * SYMBOLS**3 + code, return_inverse=True)
        total = np.bincount(back, weight)
        owner, code = key // SYMBOLS**3, key % SYMBOLS**3
        norm = np.sqrt(np.bincount(owner, total**2, minlength=len(close)))
        out = np.zeros((len(close), len(self.words)), np.float32)
        edges = np.searchsorted(owner, np.arange(len(close) + 1))
        for a in range(0, len(close), 256):
            b = min(a + 256, len(close))
            lo, hi = edges[a], edges[b]
            if hi > lo:
                scaled = self.table[code[lo:hi]] * total[lo:hi, None].astype(np.float32)
                rows = owner[lo:hi]
                begin_at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                out[rows[begin_at]] = np.add.reduceat(scaled, begin_at, axis=0)
        out /= np.maximum(norm, 1e-9)[:, None]
        near = out.max(axis=1) >= LEAST
        return close[near], out[near] ** POWER


@dataclass
class Model:
    kernel: Kernel
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True


class Sentences:
    """Similarities of the sentences of chunks; boring words are remembered by their hash."""

    def __init__(self, kernel: Kernel):
        self.kernel = kernel
        self.boring = np.zeros(SLOTS, np.uint64)

    def describe(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, greatest similarities) of every sentence with a word near a landmark."""
        m = len(self.kernel.words)
        stream, first, rows, starts = units(raw, offsets)
        if not len(first):
            return np.zeros(0, np.int64), np.zeros((0, m), np.float32)
        ends = np.append(first[1:], len(stream))
        hashes = tx.span_hashes(stream, first, ends) | np.uint64(1)
        slot = ((hashes >> np.uint64(20)) & np.uint64(SLOTS - 1)).astype(np.int64)
        fresh = np.flatnonzero(self.boring[slot] != hashes)
        if not len(fresh):
            return np.zeros(0, np.int64), np.zeros((0, m), np.float32)
        unique, at, back = np.unique(hashes[fresh], return_index=True, return_inverse=True)
        at = fresh[at]
        size = (ends - first)[at]
        begin = np.cumsum(size) - size
        kept = np.repeat(first[at] - begin, size) + np.arange(int(size.sum()))
        near, values = self.kernel.similarity(stream[kept], begin)
        place = np.full(len(unique), -1)
        place[near] = np.arange(len(near))
        dull = np.flatnonzero(place < 0)
        self.boring[slot[at[dull]]] = unique[dull]
        found = np.flatnonzero(place[back] >= 0)
        if not len(found):
            return np.zeros(0, np.int64), np.zeros((0, m), np.float32)
        which, word = place[back[found]], fresh[found]
        # A sentence ends with a full stop, a question or exclamation mark or a line.
        breaks = np.concatenate(([0], np.cumsum(_END[raw])))
        sentence = breaks[starts[word]]
        # Words come in the order of the text, so those of a sentence are neighbours.
        turn = np.flatnonzero(np.r_[True, (rows[word][1:] != rows[word][:-1]) | (sentence[1:] != sentence[:-1])])
        x = np.maximum.reduceat(values[which], turn, axis=0)
        # Several toxic words together say no more than one, so each of them has to stand for itself.
        return rows[word][turn], x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1)[:, None]


def _learned(batches: Iterator[pa.RecordBatch], kernel: Kernel) -> Iterator[pa.RecordBatch]:
    made = Sentences(kernel)
    for batch in batches:
        toxic = batch.column("toxic")
        for lo, _, raw, offsets in tx.chunks(batch.column("text")):
            row, x = made.describe(raw, offsets)
            values = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays([toxic.take(pa.array(row + lo)), values], ["toxic", "x"])


def _margins(batches: Iterator[pa.RecordBatch], model: Model, kept: str) -> Iterator[pa.RecordBatch]:
    """The column ``kept`` and the margin of each text's most toxic sentence."""
    made = Sentences(model.kernel)
    for batch in batches:
        for lo, hi, raw, offsets in tx.chunks(batch.column("text")):
            row, x = made.describe(raw, offsets)
            # A text without a word near any landmark is as far from toxic as the plainest sentence.
            best = np.full(hi - lo, min(model.bias, -1.0))
            if len(row):
                top = np.full(hi - lo, -np.inf)
                np.maximum.at(top, row, x @ model.weights + model.bias)
                best = np.where(np.isfinite(top), top, best)
            yield pa.RecordBatch.from_arrays([batch.column(kept).slice(lo, hi - lo), pa.array(best)], [kept, "margin"])


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in _margins(batches, model, "doc_id"):
        margin = batch.column("margin").to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(model.slope * margin + model.shift))], ["doc_id", "score"])


def _mark(words: Column) -> Column:
    """The smallest hash of three words in a row by each of two hash functions (of all words if there are fewer).

    ``words`` has to be a bound variable (see ``let``): as an expression it would be worked out again
    for every place.
    """
    places = F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1)))
    runs = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, 3)))
    return let(runs, lambda r: F.struct(F.array_min(r).alias("a"), F.array_min(F.transform(r, lambda h: F.xxhash64(h))).alias("b")))


def _apart(chosen: list[str], word: str, held: np.ndarray) -> bool:
    """Whether ``word`` is unlike all chosen ones; if so it is written to the next row of ``held``."""
    s = symbols_of(word)
    if len(s) < 3:
        return False
    v = features([s])[0]
    if chosen and float((held[: len(chosen)] @ v).max()) >= APART:
        return False
    held[len(chosen)] = v
    return True


def choose_landmarks(docs: DataFrame, labels: DataFrame, limit: int = LANDMARKS) -> list[str]:
    """Words that mark toxic texts, unlike one another.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. Texts that agree in the smallest shingle of
    both of two hash functions, which near copies mostly do, count as one, so that a group of copies
    doesn't make its words look toxic. The words of toxic texts are ranked by how many of these hold
    them, if nine in ten of the texts that hold them are toxic, they are in ``FEWEST`` texts, and chance
    would hardly make any of the words looked at so one-sided. Landmarks are chosen in rounds: the
    first takes a half of ``limit`` by rank, each later one the words that are in most of the toxic
    texts without a landmark so far, until no such text is left that holds another candidate.
    """
    split = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
    # Texts without a label stay where they are: a filter of bounded size tells most of them. Labels grow
    # with the corpus, so both joins are planned alike at every size.
    some = docs.where("text is not null").where(may_be_in(labels, "doc_id")(F.col("doc_id")))
    known = some.join(labels.hint("merge"), "doc_id").select("doc_id", "toxic", F.xxhash64("text").alias("tie"), F.array_distinct(split).alias("words"))
    usual = F.filter("words", lambda w: F.length(w).between(3, 24))
    known = materialise(known.select("doc_id", "toxic", "tie", let(F.col("words"), _mark).alias("mark"), usual.alias("words")), "known")
    # Of texts that count as one, the same one whatever the order of rows; only ids are dealt out for it.
    one = known.groupBy("mark", "doc_id", "toxic", "tie").agg(F.count("*").alias("copies"))
    turn = F.struct(F.xxhash64("toxic", "tie").alias("turn"), "doc_id", "toxic", "tie", "copies")
    once = materialise(one.groupBy("mark").agg(F.min(turn).alias("r")).select("r.doc_id", "r.toxic", "r.tie", "r.copies"), "chosen")
    totals = once.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    each = known.select("doc_id", "toxic", "tie", "words").join(once.hint("merge"), ["doc_id", "toxic", "tie"])
    each = each.select("doc_id", "toxic", "tie", (1 / F.col("copies")).alias("part"), F.explode("words").alias("word"))
    # A row that comes several times counts once in all.
    sums = each.groupBy("word").agg(F.round(F.sum(F.col("toxic") * F.col("part"))).alias("bad"), F.round(F.sum("part")).alias("n"))
    counts = materialise(sums.where(F.col("n") >= FEWEST), "words")
    # Log-likelihood ratio of a word's share of toxic texts against that of all; times the words looked at.
    base = F.lit(min(max((totals["bad"] or 0) / max(1, totals["n"]), 1e-9), 1 - 1e-9))
    good = F.col("n") - F.col("bad")
    ratio = F.col("bad") * F.log(F.col("bad") / (F.col("n") * base)) + F.when(good > 0, good * F.log(good / (F.col("n") * (1 - base)))).otherwise(0.0)
    tested = max(1, counts.count())
    sure = counts.where((F.col("bad") >= 0.9 * F.col("n")) & (ratio >= float(np.log(tested / CHANCE))))
    ranked = sure.orderBy(F.desc("bad"), "word").limit(CANDIDATES).select("word").collect()
    words = [r["word"] for r in ranked]
    chosen: list[str] = []
    held = np.zeros((limit, SYMBOLS**3), np.float32)
    # Which toxic texts hold which candidates: at most CANDIDATES words are sent to the texts.
    candidates = docs.sparkSession.createDataFrame([(w,) for w in words], "word string")
    among = materialise(each.where("toxic = 1").join(F.broadcast(candidates), "word").select("doc_id", "tie", "word").distinct(), "among") if words else None
    share = limit // 2
    while words and len(chosen) < limit:
        before = len(chosen)
        for w in words:
            if len(chosen) >= min(limit, before + share):
                break
            if _apart(chosen, w, held):
                chosen.append(w)
        if len(chosen) == before:
            break
        # The next round looks at the texts without any landmark.
        covered = among.where(F.col("word").isin(chosen)).select("doc_id", "tie")
        left = among.join(covered, ["doc_id", "tie"], "left_anti").groupBy("word").count()
        words = [r["word"] for r in left.orderBy(F.desc("count"), "word").limit(CANDIDATES).collect()]
        share = max(1, limit // 8)
    return chosen


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model of the labelled rows that aren't held out; None if they lack either label."""
    known = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = known.where(~held_out(F.col("doc_id"))).withColumn("key", F.xxhash64("doc_id"))
    # Of each label the rows with the smallest hashes, so that a rare label is learned from as well.
    edge = {}
    for label in (0, 1):
        edge[label] = usable.where(F.col("toxic") == label).select("key").orderBy("key").limit(sample_rows // 2).agg(F.max("key")).first()[0]
    if None in edge.values():
        return None
    picked = usable.where(F.col("key") <= F.when(F.col("toxic") == 1, edge[1]).otherwise(edge[0])).limit(2 * sample_rows)
    # The sample is bounded, so it is sent to the documents.
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id")
    clean = float(rows.where("toxic = 0").count())
    # Words are counted over all labelled rows, so that rare ones have landmarks as well.
    kernel = Kernel(choose_landmarks(docs, usable.select("doc_id", "toxic")))
    if not kernel.words:
        return None
    # Equal sentences are counted where they are made; a bounded number of them reaches the driver.
    made = rows.select("toxic", "text").mapInArrow(partial(_learned, kernel=kernel), "toxic int, x binary")
    made = made.groupBy("toxic", "x").count().withColumn("turn", F.xxhash64("x"))
    vectors = [r for label in (0, 1) for r in made.where(F.col("toxic") == label).orderBy("turn", "x").limit(SAMPLE_SENTENCES).collect()]
    if not any(r["toxic"] for r in vectors):
        return None
    x = np.frombuffer(b"".join(r["x"] for r in vectors), np.float32).reshape(-1, len(kernel.words))
    y = np.array([r["toxic"] for r in vectors])
    n = np.array([float(r["count"]) for r in vectors])
    # Each clean text has a sentence without a word near any landmark.
    x, y, n = np.vstack((x, np.zeros_like(x[:1]))), np.append(y, 0), np.append(n, clean)
    z = x @ kernel.root.astype(np.float32)
    w, b = fit_svm(z, np.where(y > 0, 1.0, -1.0), c=100.0, steps=300, counts=n)
    # In toxic texts most sentences are not: those that the first machine finds unlike are left out.
    margin = z @ w + b
    sure = (y == 0) | (margin > 0)
    if (y[sure] > 0).any():
        w, b = fit_svm(z[sure], np.where(y[sure] > 0, 1.0, -1.0), c=100.0, steps=300, counts=n[sure])
    model = Model(kernel, (kernel.root @ w).astype(np.float32), b, 1.0, 0.0)
    # The curve is fitted to whole texts of the sample, one margin each.
    made = rows.select("toxic", "text").mapInArrow(partial(_margins, model=model, kept="toxic"), "toxic int, margin double").collect()
    scores, truth = np.array([r["margin"] for r in made]), np.array([float(r["toxic"]) for r in made])
    model.slope, model.shift = fit_sigmoid(scores, truth)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row for every row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have the score of a text without a word near any landmark. Without a model
    every score is 0. Repeated rows are scored one by one and alike; only ``doc_id`` and ``text`` are
    used.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        docs = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:
        docs = docs.mapInArrow(partial(_scored, model=model), "doc_id long, score double")
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
