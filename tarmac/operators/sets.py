"""Unions, complements and column-set checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts; a column missing from a part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def endpoints(df: DataFrame, cols: Sequence[str] = ("Origin", "Dest"), out: str = "IATA") -> DataFrame:
    """Distinct values over several columns, read in one scan."""
    return df.select(F.explode(F.array(*cols)).alias(out)).filter(F.col(out).isNotNull()).distinct()


def complement(df: DataFrame, chosen: DataFrame, ids: Sequence[str]) -> DataFrame:
    return df.join(chosen.select(*ids), list(ids), "left_anti")


def column_report(df: DataFrame, expected: Iterable[str], forbidden: Iterable[str] = ()) -> dict[str, list[str]]:
    """Expected columns that are missing and forbidden ones that are present; reads no data."""
    have = set(df.columns)
    return {"missing": sorted(set(expected) - have), "forbidden": sorted(set(forbidden) & have)}


def shared_by_all(df: DataFrame, member: str, group: str, at_least: int) -> DataFrame:
    """Members that occur in at least so many groups."""
    n = df.groupBy(member).agg(F.countDistinct(group).alias("n_groups"))
    return n.filter(F.col("n_groups") >= at_least)
