"""Keyed upsert and delete as pure functions from old state to new state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.operators.clean import normalise_ids
from tillwright.operators.joins import key_overlap, without_keys
from tillwright.operators.windows import keep_last, latest_by
from tillwright.schemas import SchemaError


def _keyed(df: DataFrame, key: str, timestamp: str, side: str) -> DataFrame:
    """Trimmed text key, null keys dropped, timestamp typed (unreadable is null)."""
    if key not in df.columns:
        raise SchemaError(f"{side} has no key column {key}")
    df = normalise_ids(df).withColumn(key, F.trim(F.col(key).cast("string")))
    if timestamp in df.columns:
        moment = F.col(timestamp)
        if df.schema[timestamp].dataType.typeName() == "string":
            moment = moment.try_cast("timestamp")
        df = df.withColumn(timestamp, moment)
    return df.filter(F.col(key).isNotNull())


def align(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Same columns on both sides, old order first; what is missing becomes null."""
    names = [*existing.columns, *[n for n in incoming.columns if n not in existing.columns]]
    types = {f.name: f.dataType for f in [*incoming.schema.fields, *existing.schema.fields]}

    def shape(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                (F.col(n) if n in df.columns else F.lit(None)).cast(types[n]).alias(n)
                for n in names
            ]
        )

    return shape(existing), shape(incoming)


def dedupe_incoming(
    incoming: DataFrame, key: str, timestamp: str = "updated_at", arrival: list[str] | None = None
) -> DataFrame:
    """One row per key of a batch: latest timestamp, else last arrival."""
    df = _keyed(incoming, key, timestamp, "incoming")
    order = [timestamp] if timestamp in df.columns else list(arrival or [])
    return keep_last(df, [key], order)


def upsert(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str,
    timestamp: str = "updated_at",
    arrival: list[str] | None = None,
) -> DataFrame:
    """New state: every untouched row survives, every key occurs once.

    With a timestamp column the latest version of a key wins, so an older
    incoming row loses; otherwise the incoming row wins. One shuffle by key, and
    at most one row per key and task in it.
    """
    if existing is None:
        return dedupe_incoming(incoming, key, timestamp, arrival)
    new = _keyed(incoming, key, timestamp, "incoming")
    old = _keyed(existing, key, timestamp, "existing")
    timed = timestamp in new.columns or timestamp in old.columns
    if not timed and arrival:
        new = keep_last(new, [key], arrival)
    # Each side's own duplicates and the contest between the sides have the same
    # order (time, side, content), so one pass over the union settles both.
    old, new = align(old, new)
    return latest_by(old, new, [key], timestamp if timed else None)


def replace_keys(
    existing: DataFrame | None, incoming: DataFrame, deletes: DataFrame | None, key: str
) -> DataFrame:
    """``upsert`` after ``apply_deletes``, where each side has a key once and no timestamp.

    Incoming rows win, so the old rows are shuffled once, to meet the keys that leave them,
    and the incoming rows not at all.
    """
    new = _keyed(incoming, key, "updated_at", "incoming")
    if existing is None:
        return new
    old, new = align(_keyed(existing, key, "updated_at", "existing"), new)
    gone = new.select(key)
    if deletes is not None and key in deletes.columns:
        gone = gone.unionByName(deletes.select(F.col(key).cast("string").alias(key)))
    return without_keys(old, gone.filter(F.col(key).isNotNull()), [key]).unionByName(new)


def upsert_counts(existing: DataFrame | None, incoming: DataFrame, key: str) -> DataFrame:
    """One row: inserted and matched keys."""
    new = _keyed(incoming, key, "updated_at", "incoming")
    if existing is None:
        return new.agg(
            F.count_distinct(key).alias("inserted"), F.lit(0).cast("bigint").alias("matched")
        )
    return key_overlap(new, _keyed(existing, key, "updated_at", "existing"), key)


def apply_deletes(existing: DataFrame | None, deletes: DataFrame, key: str) -> DataFrame | None:
    """State without the deleted keys; nothing to do without state or key column."""
    if existing is None or key not in existing.columns or key not in deletes.columns:
        return existing
    return without_keys(existing, deletes.filter(F.col(key).isNotNull()), [key])
