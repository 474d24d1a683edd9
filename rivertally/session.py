"""Session settings and durable materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle further on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

#: The shuffle files of a query are dropped when it ends, not when the driver happens to collect garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session while a query runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` takes dotted keys with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can read: the one the session names for checkpoints.

    Only where the session names none and all work is done on this machine (tests, local runs) a fresh
    folder is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="rivertally-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder of its own below the shared one; nothing is created."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` out once and go on from the written table.

    The table lies in the shared folder, so it outlives any executor, cuts the lineage, and later
    steps read only the columns they need. Nothing reads the shuffles of the write again, so Spark drops their files at its end.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, "table"), spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        # Scratch is written once and read a few times: the denser codec saves more disk than it costs time.
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
