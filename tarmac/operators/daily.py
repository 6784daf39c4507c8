"""One row per key and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import num

DATE = "FlightDate"
LATE_AIRCRAFT_MINUTES = 15


def late_aircraft(c: str = "LateAircraftDelay") -> Column:
    """Delayed at least 15 minutes by a late inbound aircraft; unknown counts as no."""
    return F.coalesce(num(c), F.lit(0.0)) >= LATE_AIRCRAFT_MINUTES


def daily_agg(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Several measures per key and day in one pass; rows without key or day are left out."""
    return (
        df.na.drop(subset=[*keys, DATE])
        .groupBy(*keys, DATE)
        .agg(*[expr.alias(name) for name, expr in measures.items()])
    )


def daily_mean(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Mean of the known values; a day without any known value has no row."""
    return daily_agg(df.filter(num(value).isNotNull()), keys, {out: F.avg(num(value))})


def daily_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median over flights.

    Rows are counted per distinct value before the final aggregate, whose state is then the number
    of distinct minutes in a key's day, however many flights share it.
    """
    known = df.filter(num(value).isNotNull()).na.drop(subset=[*keys, DATE])
    counts = known.groupBy(*keys, DATE, num(value).alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys, DATE).agg(F.expr("percentile(_x, 0.5, _n)").alias(out))


def daily_rate(df: DataFrame, keys: Sequence[str], held: Column, out: str) -> DataFrame:
    """Share of rows where the condition holds; rows where it is unknown count as no."""
    return daily_agg(df, keys, {out: F.avg(F.coalesce(held, F.lit(False)).cast("double"))})
