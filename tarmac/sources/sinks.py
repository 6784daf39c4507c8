"""Writing stages and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_path(template: str, target: str = "dep", thr: int | None = None) -> str:
    return template.format(target=target, thr=thr)


def write_stage(df: DataFrame, template: str, target: str = "dep", thr: int | None = None) -> str:
    path = stage_path(template, target, thr)
    df.write.mode("overwrite").parquet(path)
    return path


def write_per_threshold(df: DataFrame, path: str) -> None:
    """One folder per threshold from rows that carry ``thr``."""
    df.write.mode("overwrite").partitionBy("thr").parquet(path)


def write_report(stats: DataFrame, path: str) -> None:
    """A long statistics table as JSON lines in one file; it has a few rows per column of the data."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def json_safe(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places, with NaN and infinities as NULL."""
    def safe(c: str):
        x = F.col(c)
        bad = F.isnan(x) | (F.abs(x) == float("inf"))
        return F.when(~bad, F.round(x, 6))

    return df.withColumns({n: safe(n) for n, t in df.dtypes if t in ("double", "float")})
