"""Language of a text: its family first, then one-versus-one machines within the family."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .common import held_out
from .svm import fit_sigmoid, fit_svm, sigmoid

# At most so many labelled rows are learned from, those with the smallest hash of their id.
SAMPLE_ROWS = 3000
BUCKETS = 4096
ROWS_AT_ONCE = 512

# Families of languages by code; a language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# Letters of any alphabet as lower-case bytes, everything else as a blank.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = _LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of hashed counts of byte trigrams, scaled to unit length."""
    n = len(offsets) - 1
    out = np.zeros((n, BUCKETS), np.float32)
    if len(raw) >= 3:
        x = _LETTER[raw].astype(np.uint64)
        code = x[:-2] | x[1:-1] << np.uint64(8) | x[2:] << np.uint64(16)
        row = np.searchsorted(offsets, np.arange(len(code)), "right") - 1
        inside = (np.arange(len(code)) + 2 < offsets[row + 1]) & ((x[:-2] != 32).astype(np.int8) + (x[1:-1] != 32) + (x[2:] != 32) >= 2)
        bucket = (tx.mix(code[inside]) & np.uint64(BUCKETS - 1)).astype(np.int64)
        out += np.bincount(row[inside] * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
        np.sqrt(out, out=out)
        out /= np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-6)
    return out


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for lo, hi, raw, offsets in tx.chunks(column):
        for a in range(0, hi - lo, ROWS_AT_ONCE):
            b = min(a + ROWS_AT_ONCE, hi - lo)
            yield lo + a, _counts(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


@dataclass
class Pairwise:
    """One machine for each pair of classes; the class with the most agreement wins."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray

    @classmethod
    def fit(cls, names: list[str], x: np.ndarray, y: np.ndarray) -> Pairwise:
        pairs = list(combinations(range(len(names)), 2))
        w, b, a = np.zeros((BUCKETS, len(pairs)), np.float32), np.zeros(len(pairs)), np.ones(len(pairs))
        for k, (i, j) in enumerate(pairs):
            pick = (y == i) | (y == j)
            side = np.where(y[pick] == i, 1.0, -1.0)
            w[:, k], b[k] = fit_svm(x[pick], side)
            slope, shift = fit_sigmoid(x[pick] @ w[:, k] + b[k], (side > 0).astype(float))
            w[:, k], b[k], a[k] = w[:, k] * slope, b[k] * slope + shift, 1.0
        return cls(names, w, b, a)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        n = len(self.names)
        if n == 1:
            return np.ones((len(x), 1))
        out = np.zeros((len(x), n))
        p = sigmoid((x @ self.weights + self.bias) * self.slope)
        for k, (i, j) in enumerate(combinations(range(n), 2)):
            out[:, i] += p[:, k]
            out[:, j] += 1 - p[:, k]
        return out * 2 / (n * (n - 1))


@dataclass
class Model:
    families: Pairwise
    within: list[Pairwise]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        p = self.families.probabilities(x)
        best = p.argmax(axis=1)
        names, score = np.empty(len(x), object), np.zeros(len(x))
        for f, inner in enumerate(self.within):
            rows = np.flatnonzero(best == f)
            if len(rows):
                q = inner.probabilities(x[rows])
                top = q.argmax(axis=1)
                names[rows] = np.array(inner.names, object)[top]
                # Agreement of k classes sums to 1 with at most 2 / k for one; scaled to reach 1.
                score[rows] = p[rows, f] * len(self.families.names) / 2 * q[np.arange(len(rows)), top] * len(inner.names) / 2 if len(inner.names) > 1 and len(self.families.names) > 1 else np.maximum(p[rows, f], 0.5)
        return list(names), np.clip(score, 0.0, 1.0)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, x in _vectors(batch.column("text")):
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(lo, len(x)), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model of the languages of the rows that aren't held out; None without such rows."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("doc_id"))
    last = usable.select("h").orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    if last is None:
        return None
    rows = usable.where(F.col("h") <= last).select("lang", "text").mapInArrow(_sampled, "lang string, x binary").limit(sample_rows).collect()
    langs = sorted({r["lang"] for r in rows})
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(-1, BUCKETS)
    lang = np.array([r["lang"] for r in rows])
    family = np.array([_FAMILY.get(v, v) for v in lang])
    names = sorted(set(family))
    within = []
    for f in names:
        own = [v for v in langs if _FAMILY.get(v, v) == f]
        pick = family == f
        within.append(Pairwise.fit(own, x[pick], np.array([own.index(v) for v in lang[pick]])))
    return Model(Pairwise.fit(names, x, np.array([names.index(f) for f in family])), within)


def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, x in _vectors(batch.column("text")):
            names, score = model.predict(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, len(x)), batch.column("letters").slice(lo, len(x)), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "letters", "lang_pred", "score"],
            )


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row for every row of ``docs``: doc_id, held_out, lang_pred, score.

    A null text or one without a letter is ``und`` with score 0, and so is everything without a model.
    Repeated rows are judged one by one and alike; ties go to the first name. Only ``doc_id`` and
    ``text`` are used.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", letters.alias("letters"))
    if model is None:
        docs = docs.select("doc_id", F.lit(False).alias("letters"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        docs = docs.mapInArrow(partial(_predicted, model=model), "doc_id long, letters boolean, lang_pred string, score double")
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
    )
