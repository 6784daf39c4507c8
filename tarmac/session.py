"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession


# A generated method of more byte code than this is never compiled by the JVM; Spark's own limit is 65,535.
# Wide rows pass it easily and are then interpreted; below the limit operators are generated one by one.
METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(app: str = "tarmac", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC wall clocks and adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **METHOD_LIMIT,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor reaches, as named by ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master, where driver and executors share one disk.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    known = context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="tarmac-")
    context.setCheckpointDir(made)
    return context.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Later stages then start from files that outlive an executor, and values that depend on the
    physical layout (a partition number) can no longer change.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is executed here leaves no shuffle files: they go when it ends, not when its plan is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialise_rows(parts: Iterable[DataFrame], label: str, row: str, rows: int) -> DataFrame:
    """Write tables that hold the row number ``row``, one after the other, and read them as one.

    They are stored in buckets of ``row``, as many as suit a fact of so many ``rows``; tables written for
    the same fact are joined by it without a shuffle. The shuffles of a part are dropped before the next
    one begins.
    """
    name = f"tarmac_{label}_{uuid.uuid4().hex}"
    for df in parts:
        spark = df.sparkSession
        width = max(min(shuffle_width(spark), rows // 20_000 + 1), rows // 200_000 + 1)
        writer = df.repartition(width, row).write.bucketBy(width, row).sortBy(row).option("compression", "zstd")
        with shuffles_dropped(spark):
            writer.option("path", f"{shared_dir(spark)}/{name}").mode("append").saveAsTable(name)
    return spark.table(name)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
