"""Pipeline runs and events: recording, selection, key figures."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.sources.sinks import append_checked

RUN_SCHEMA = (
    "run_id bigint, file_name string, source string, ingestion_time timestamp, "
    "record_count bigint, valid_count bigint, rejected_count bigint, "
    "processing_status string, processing_time double, pipeline_version string, "
    "error_count bigint, data_quality_failures bigint, job_name string, "
    "error_message string, created_at timestamp"
)
LINEAGE_COLUMNS = [
    "run_id", "file_name", "source", "ingestion_time", "record_count",
    "processing_status", "processing_time", "error_count", "job_name", "error_message",
]


def run_status(valid: int, rejected: int) -> str:
    if not rejected:
        return "SUCCESS"
    return "PARTIAL" if valid else "FAILED"


def derive_events(runs: DataFrame, message_length: int | None = None) -> DataFrame:
    """One event per run, one more for an error message and for quality failures.

    Error messages are whole unless a length is given.
    """
    told = F.col("error_message")
    if message_length is not None:
        told = F.substring(told, 1, message_length)
    failed = F.col("processing_status") == "FAILED"
    severity = (
        F.when(failed, "ERROR").when(F.col("rejected_count") > 0, "WARNING").otherwise("INFO")
    )

    def event(level, kind: str, message):
        return F.struct(
            F.lit(level).alias("severity") if isinstance(level, str) else level.alias("severity"),
            F.lit(kind).alias("event_type"),
            message.alias("message"),
        )

    summary = F.concat(
        "job_name", F.lit(": "), "processing_status",
        F.lit("; records="), F.col("record_count").cast("string"),
        F.lit("; rejected="), F.col("rejected_count").cast("string"),
    )
    has_error = F.coalesce(F.col("error_message") != "", F.lit(False))
    has_failures = F.coalesce(F.col("data_quality_failures") > 0, F.lit(False))
    events = F.array_compact(
        F.array(
            event(severity, "PIPELINE_RUN", summary),
            F.when(
                has_error,
                event("ERROR", "PIPELINE_ERROR", told),
            ),
            F.when(
                has_failures,
                event(
                    "WARNING",
                    "DATA_QUALITY",
                    F.concat(
                        F.col("data_quality_failures").cast("string"),
                        F.lit(" data-quality failure(s) recorded."),
                    ),
                ),
            ),
        )
    )
    return runs.select(
        "run_id", F.col("ingestion_time").alias("event_time"), F.inline(events)
    )


def record_runs(runs: DataFrame, base: str) -> None:
    """Append finished runs and their events to the two log tables."""
    append_checked(runs, f"{base}/pipeline_runs")
    append_checked(derive_events(runs), f"{base}/pipeline_events")


def record_run(
    spark: SparkSession,
    base: str,
    *,
    run_id: int,
    file_name: str,
    source: str,
    record_count: int,
    valid_count: int,
    rejected_count: int,
    processing_time: float,
    job_name: str,
    pipeline_version: str,
    status: str | None = None,
    error_count: int = 0,
    dq_failures: int = 0,
    error_message: str | None = None,
    at: datetime | None = None,
) -> int:
    """Append one run and its events to the two log tables."""
    at = at or datetime.now()
    row = (
        run_id, file_name, source, at, record_count, valid_count, rejected_count,
        status or run_status(valid_count, rejected_count), round(float(processing_time), 3),
        pipeline_version, error_count, dq_failures, job_name, error_message, at,
    )
    record_runs(spark.createDataFrame([row], RUN_SCHEMA).coalesce(1), base)
    return run_id


def select_runs(
    runs: DataFrame,
    statuses: list[str] | None = None,
    jobs: list[str] | None = None,
    days: int | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Runs by status, job and age. An empty list selects nothing, None everything."""
    for name, wanted in (("processing_status", statuses), ("job_name", jobs)):
        if wanted is not None:
            runs = runs.filter(F.col(name).isin(*wanted) if wanted else F.lit(False))
    if days is not None:
        cutoff = (now or datetime.now()) - timedelta(days=days)
        runs = runs.filter(F.col("ingestion_time") >= F.lit(cutoff))
    return runs


def select_events(events: DataFrame, severities: list[str]) -> DataFrame:
    return events.filter(F.col("severity").isin(*severities) if severities else F.lit(False))


def lineage(runs: DataFrame) -> DataFrame:
    return runs.select(*[n for n in LINEAGE_COLUMNS if n in runs.columns])
