"""Connected components of a table of links, by repeated joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

# A key with more than one in so many rows is hot; there can't be more of them.
HOT_SHARE = 200


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Each round sends every node's smallest known neighbour to its larger neighbours (large star) and
    then hangs the smaller ones onto the smallest (small star). Both are aggregations with partial
    sums, so a node with millions of links is reduced before the shuffle, and the number of links
    never grows beyond that of the nodes plus links at hand. Every round is written to the shared
    folder. Without links the result is empty.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialise(edges, "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == seen:
            break
        seen = state
    # A fixed point is a set of stars: every node has one link, to the smallest of its component.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def attach(rows: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``named`` (one row for each key), nulls where it has none.

    Keys of more than one in ``HOT_SHARE`` rows, of which there are fewer than that, are sent to the
    rows; only the others are dealt out by key.
    """
    total = rows.count()
    hot = materialise(rows.groupBy(key).count().where(F.col("count") * HOT_SHARE > total).select(key), "hot")
    few = materialise(named.join(F.broadcast(hot), key, "left_semi"), "hot")
    others = [c for c in named.columns if c != key]
    usual = rows.join(F.broadcast(hot), key, "left_anti").join(named, key, "left")
    often = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(few), key, "left")
    return reduce(DataFrame.union, [d.select(*rows.columns, *others) for d in (usual, often)])
