"""File streams: new files to checked appends or keyed state.

Each stream runs once over what has arrived (``availableNow``) and keeps its
progress in a checkpoint in the shared folder; a restart continues there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillwright.operators.quality import split_deletes
from tillwright.plans.state import apply_changes
from tillwright.schemas import text_schema, validate_schema
from tillwright.sources import storage
from tillwright.sources.tables import Warehouse


def csv_stream(
    spark: SparkSession, folder: str, columns: list[str], files_per_batch: int | None = None
) -> DataFrame:
    """New CSV files below a folder as text. Producers must write atomically."""
    reader = (
        spark.readStream.option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .schema(text_schema(columns))
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def parquet_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.option("pathGlobFilter", pattern).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_batches(
    stream: DataFrame,
    checkpoint: str,
    batch: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> None:
    """Process everything available, batch by batch, and return."""
    query = (
        stream.writeStream.foreachBatch(batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_load(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Create the table on first load, later append new files after a schema check.

    A batch lands in a folder of its own, so repeating it after a failure
    replaces its rows instead of doubling them.
    """
    spark = stream.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        part = f"{target}/batch={batch_id}"
        if storage.has_data(spark, target):
            table = spark.read.parquet(target).drop("batch")
            validate_schema(df, table.schema)
        df.write.mode("overwrite").parquet(part)

    run_batches(stream, checkpoint, batch)


def upsert_load(
    stream: DataFrame,
    warehouse: Warehouse,
    table: str,
    key: str,
    checkpoint: str,
    timestamp: str = "updated_at",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int | None = None,
) -> None:
    """Keyed state from a stream of change records.

    Deletes of a batch apply to the old state first; its other rows are then
    upserted, in one rewrite of the table or, with ``buckets``, of the buckets
    the batch touches. Repeating a batch gives the same state.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        changes = prepare(df) if prepare else df
        loads, deletes = split_deletes(changes)
        apply_changes(warehouse, table, key, loads, deletes, timestamp, buckets=buckets)

    run_batches(stream, checkpoint, batch)
