"""Which input files have been loaded, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.sources.sinks import append
from tillwright.sources.tables import Warehouse

COLUMNS = ["dataset", "path", "modified_time", "size"]


def list_files(spark: SparkSession, folder: str, dataset: str, pattern: str = "*.csv") -> DataFrame:
    """Path below the folder, change time and size; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    return files.select(
        F.lit(dataset).alias("dataset"),
        F.substring_index("path", f"{folder.rstrip('/')}/", -1).alias("path"),
        F.col("modificationTime").alias("modified_time"),
        F.col("length").alias("size"),
    )


def read_ledger(warehouse: Warehouse, name: str = "file_ledger") -> DataFrame | None:
    return warehouse.read_or_none(name)


def latest_entries(ledger: DataFrame) -> DataFrame:
    """The newest entry of each dataset and path."""
    order = F.struct("processed_at", "modified_time", "size")
    return ledger.groupBy("dataset", "path").agg(
        F.max_by(F.struct("modified_time", "size"), order).alias("entry")
    ).select("dataset", "path", "entry.modified_time", "entry.size")


def new_or_changed(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files whose path is unknown or whose time or size differs from the latest entry."""
    if ledger is None:
        return files
    return files.join(latest_entries(ledger), COLUMNS, "left_anti")


def new_paths(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files whose path is unknown; a changed file is not new."""
    if ledger is None:
        return files
    return files.join(ledger.select("dataset", "path"), ["dataset", "path"], "left_anti")


def oldest_first(files: DataFrame) -> DataFrame:
    return files.orderBy("modified_time", "path")


def mark_processed(
    warehouse: Warehouse,
    files: DataFrame,
    at: str | None = None,
    name: str = "file_ledger",
    records: int | None = None,
) -> None:
    """Record files after their rows are safely written, with the run's time and rows."""
    moment = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    marked = files.select(
        *COLUMNS, moment.alias("processed_at"), F.lit(records).cast("bigint").alias("run_records")
    )
    append(marked, warehouse.path(name))


def ledger_state(ledger: DataFrame) -> DataFrame:
    """Per dataset: files, bytes and newest change of their latest entries, last run and its rows."""
    files = latest_entries(ledger).groupBy("dataset").agg(
        F.count("path").alias("files"),
        F.sum("size").alias("bytes"),
        F.max("modified_time").alias("newest"),
    )
    runs = ledger.groupBy("dataset").agg(
        F.max("processed_at").alias("last_run"),
        F.max_by("run_records", "processed_at").alias("last_records"),
    )
    return files.join(runs, "dataset")


def after_watermark(df: DataFrame, column: str, state: DataFrame | None, fallback=None) -> DataFrame:
    """Rows newer than the state's greatest value, or than the fallback where there is none.

    The bound is a scalar in the plan; without either the query fails.
    """
    kind = df.schema[column].dataType
    saved = state.agg(F.max(column)).scalar() if state is not None else F.lit(None)
    none = F.raise_error(F.lit("neither a saved value nor a fallback to start from"))
    return df.filter(F.col(column) > F.coalesce(saved, F.lit(fallback), none.cast(kind)))
