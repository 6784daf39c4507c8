"""Positions of pattern matches in a text, in built-in expressions.

Spark's pattern functions give matches and the pieces between them; their lengths add up to the
positions. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let

BLOCK = 256

SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _running(x: Column, start: Column) -> Column:
    zero = F.struct(start.cast("long").alias("t"), F.expr("cast(array() as array<bigint>)").alias("out"))
    step = lambda acc, v: F.struct((acc["t"] + v).alias("t"), F.concat(acc["out"], F.array(acc["t"] + v)).alias("out"))
    return F.aggregate(x, zero, step, lambda acc: acc["out"])


def running_sums(x: Column) -> Column:
    """The running totals of a non-empty array of long; blocks keep the copying short for long arrays."""

    def of_groups(groups):
        totals = F.transform(groups, lambda g: F.aggregate(g, F.lit(0).cast("long"), lambda a, v: a + v))
        ends = let(_running(totals, F.lit(0)), lambda e: F.transform(groups, lambda g, i: _running(g, F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(e, i - 1)))))
        return F.flatten(ends)

    numbers = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))
    return let(F.transform(numbers, lambda g: F.slice(x, g * BLOCK + 1, BLOCK)), of_groups)


def matches(text: Column, pattern: str, kind: int, valid=None) -> Column:
    """All leftmost non-overlapping matches of a pattern as ``SPAN``; those that fail ``valid`` go."""
    empty = F.expr(f"cast(array() as {SPAN})")

    def placed(x):
        lengths = F.transform(x["found"], lambda m, i: (F.length(F.get(x["pieces"], i)) + F.length(m)).cast("long"))
        return let(
            running_sums(lengths),
            lambda ends: F.transform(
                x["found"],
                lambda m, i: F.struct((F.get(ends, i) - F.length(m)).alias("start"), F.lit(kind).alias("kind"), F.get(ends, i).alias("end"), m.alias("value")),
            ),
        )

    both = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    found = let(both, placed)
    if valid is not None:
        found = F.filter(found, lambda s: valid(s["value"]))
    return F.when(text.rlike(pattern), found).otherwise(empty)


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
