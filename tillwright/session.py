"""Session settings and the shared folder jobs write through."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on; all can be changed per session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the split costs the next stage a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
}


def default_shuffle_partitions() -> int:
    """Starting shuffle width; adaptive execution merges what is too small."""
    return max(200, 2 * (os.cpu_count() or 4))


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "tillwright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    # Checkpoint files go once no frame refers to them any more.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    builder = builder.config(
        "spark.sql.shuffle.partitions",
        str(shuffle_partitions or default_shuffle_partitions()),
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        base = named
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
        return base.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="tillwright-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder, one per call."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame written once to the shared folder and read back, and the folder."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, so a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
