"""Exact ranks and quantiles of groups of any size.

A window over one group runs in one task. Here rows are first counted per distinct value, the
counts are cut into balanced value ranges, and running totals are taken inside each range and then
over the (few) ranges, so a group that holds most of the table is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, shuffle_width

_RANGE = "_range"


def value_counts(df: DataFrame, keys: Sequence[str], value: str, count: str = "n") -> DataFrame:
    """Rows per distinct value; NULL values are left out."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias(count))
    )


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Adds ``before_{s}`` (total of the rows ordered earlier) and ``total_{s}`` per key.

    ``df`` must hold one row per key and order value.
    """
    width = shuffle_width(df.sparkSession)
    ranged = materialise(
        df.repartitionByRange(width, *keys, *order).withColumn(_RANGE, F.spark_partition_id()),
        "ranges",
    )
    inside = Window.partitionBy(*keys, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    part = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    ranges = ranged.groupBy(*keys, _RANGE).agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    ranges = ranges.select(
        *keys,
        _RANGE,
        *[F.coalesce(F.sum(f"_sum_{s}").over(part), F.lit(0)).alias(f"_part_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(whole).alias(f"total_{s}") for s in sums],
    )
    local = ranged.select("*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_in_{s}") for s in sums])
    return local.join(ranges, [*keys, _RANGE]).select(
        *df.columns,
        *[(F.col(f"_in_{s}") + F.col(f"_part_{s}")).alias(f"before_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )


def average_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key and value: its ``n``, the ``rank`` its ties share, and ``total_n``."""
    totals = running_totals(value_counts(df, keys, value), keys, [value], ["n"])
    return totals.select(
        *keys, value, "n", (F.col("before_n") + (F.col("n") + 1) / 2).alias("rank"), "total_n"
    )


def _at(position: Column, value: str) -> Column:
    holds = (F.col("before_n") <= position) & (position < F.col("before_n") + F.col("n"))
    return F.max(F.when(holds, F.col(value)))


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Exact quantiles per key, interpolated linearly between neighbours."""
    totals = running_totals(value_counts(df, keys, value), keys, [value], ["n"])
    lows, highs, spots = [], [], []
    for i, p in enumerate(probs):
        spot = (F.col("total_n") - 1) * float(p)
        lows.append(_at(F.floor(spot), value).alias(f"_low{i}"))
        highs.append(_at(F.ceil(spot), value).alias(f"_high{i}"))
        spots.append((F.max(spot) - F.floor(F.max(spot))).alias(f"_frac{i}"))
    picked = totals.groupBy(*keys).agg(F.max("total_n").alias("n"), *lows, *highs, *spots)
    out = [
        (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_frac{i}")).alias(name)
        for i, name in enumerate(names)
    ]
    return picked.select(*keys, "n", *out)


def long_form(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """One row per input row and column: ``feature`` and ``value`` as double, NULLs kept."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*ids, F.inline(pairs))


def quantile_bins(
    df: DataFrame, feats: Sequence[str], q: int, keep: Sequence[str] = (), by: Sequence[str] = ()
) -> DataFrame:
    """Long rows (``by``, ``keep``, ``feature``, ``value``, ``bin``) with equal-count bins.

    Edges that coincide are dropped, and bins are closed on the right with the first one closed on
    both sides. A feature with a single distinct value has no bin.
    """
    rows = long_form(df, feats, [*by, *keep]).filter(F.col("value").isNotNull())
    names = [f"_e{i}" for i in range(q + 1)]
    edges = quantiles(rows, [*by, "feature"], "value", [i / q for i in range(q + 1)], names)
    edges = edges.select(*by, "feature", F.array_distinct(F.array(*names)).alias("_edges"))
    below = F.size(F.filter("_edges", lambda e: e < F.col("value")))
    # The array is short (q + 1) and fixed, so the bin number costs no join on ranges. The edges are sent
    # to the rows: a join by feature would put all rows of a feature into one task.
    return (
        rows.join(F.broadcast(edges), [*by, "feature"])
        .filter(F.size("_edges") > 1)
        .withColumn("bin", F.greatest(below - 1, F.lit(0)))
        .withColumn("n_bins", F.size("_edges") - 1)
        .drop("_edges")
    )
