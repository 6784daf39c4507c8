"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import METHOD_LIMIT

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Run
    ids: str
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, ids: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its name; ``ids`` are the rows of the operator list it covers."""

    def keep(run: Run) -> Run:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")

        def in_utc(spark: SparkSession, sf: str) -> DataFrame:
            # Wall clocks and instants of the tables are read in UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            for key, value in METHOD_LIMIT.items():
                spark.conf.set(key, value)
            return run(spark, sf)

        ENTRIES[name] = Entry(name, in_utc, ids, sql)
        return run

    return keep


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show, and dates as ISO text.

    The small shift keeps exact ties off the rounding edge, where the last bit would decide.
    """
    made = {}
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            made[name] = F.round(c + 1e-9, digits) + F.lit(0.0)
        elif kind == "date":
            made[name] = c.cast("string")
        elif kind.startswith("timestamp"):
            made[name] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(made) if made else df


def load_all() -> dict[str, Entry]:
    from . import (  # noqa: F401
        aggregates,
        joined,
        lagged,
        modelled,
        ordered,
        planned,
        quality,
        sampled,
        scalars,
        scans,
        statistics,
    )

    return ENTRIES
