"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import materialise, shuffle_width

__all__ = ["filter_bits", "filter_table", "free_name", "held_out", "in_filter", "let", "materialise", "may_be_in", "shuffle_width", "small_batches", "table", "tokenizer_file"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores as it takes to differ from all names in use."""
    used = {t.lower() for t in taken}
    while name in used:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark's setting for the bytes of an Arrow batch (64 MB unless set), and what it is for large rows.
BATCH_BYTES, SMALL_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile passes rows to Python, and back, a few megabytes at a time.

    Each side holds a batch or two, and buffers that grew to their size, for as long as it lives.
    """
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, SMALL_BATCH)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, which every machine has under the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


# A filter of ids has eight bits for each of them, within these bounds (8 KB and 16 MB).
FEWEST_BITS, MOST_BITS = 1 << 16, 1 << 27


def filter_bits(n: int) -> int:
    """The size in bits of a filter of ``n`` ids."""
    bits = FEWEST_BITS
    while bits < min(8 * n, MOST_BITS):
        bits *= 2
    return bits


def filter_table(slots: DataFrame, bits: int) -> np.ndarray:
    """The bits, 64 a word, that the one column of ``slots`` (0 to ``bits`` - 1) sets."""
    slots = slots.toDF("slot").where("slot is not null")
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    table = np.zeros(bits >> 6, np.uint64)
    for part in words.toArrow().to_batches():
        table[part.column("word").to_numpy()] = part.column("bits").to_numpy().view(np.uint64)
    return table


def in_filter(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether the bits of the given slots are set."""
    slots = slots.astype(np.int64)
    return (table[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) == 1


def may_be_in(ids: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test that is true for every value of ``key`` in ``ids`` and for few others.

    It spares a join the rows that have no partner; the join itself stays exact. Its size is bounded:
    beyond some sixteen million ids it lets more rows pass.
    """
    bits = filter_bits(ids.count())

    def slot(value: Column) -> Column:
        return F.pmod(F.xxhash64(value.cast("long")), F.lit(bits))

    table = filter_table(ids.select(slot(F.col(key))), bits)

    def hit(slots: pd.Series) -> pd.Series:
        return pd.Series(in_filter(table, slots.to_numpy()))

    test = F.pandas_udf(hit, "boolean")
    return lambda value: test(slot(value))
