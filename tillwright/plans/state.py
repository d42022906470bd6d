"""Applying a batch of changes to a keyed table.

Without a table format there is no MERGE, so rows change by rewriting files. The
table is kept in buckets by a hash of its key, and a batch rewrites only the buckets
its keys fall into. The catalogue's view of the table selects each bucket from the
folder that it was last written to and knows how many buckets there are, so a batch
becomes visible in one step and a table is never written with another count.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillwright.operators.clean import null_columns_to_string
from tillwright.operators.upsert import apply_deletes, replace_keys, upsert
from tillwright.sources import storage
from tillwright.sources.tables import Warehouse

BUCKET = storage.BUCKET
#: Buckets of a new table; a large one should get about one per GB.
BUCKETS = 16


class BucketError(ValueError):
    """A table was addressed with another bucket count than it has."""


def bucket_of(key: str, buckets: int) -> Column:
    text = F.trim(F.col(key).cast("string"))
    return F.coalesce(F.pmod(F.xxhash64(text), F.lit(buckets)), F.lit(0)).cast("int")


def apply_changes(
    zones: Warehouse,
    table: str,
    key: str,
    incoming: DataFrame,
    deletes: DataFrame | None = None,
    timestamp: str = "updated_at",
    arrival: list[str] | None = None,
    buckets: int | None = None,
    unique: bool = False,
) -> None:
    """Deletes leave the old state first, then the incoming rows are upserted.

    ``unique`` says that ``incoming`` has rows, and one per key. Then no side
    is put in order by key again: the old rows only meet the incoming and deleted keys.

    Applying the same batch again gives the same state, so a failed run is simply
    repeated. ``buckets`` is taken from the table where it has a count; another one is
    refused. A table that was not in buckets is put into them.
    """
    spark, path = zones.spark, zones.path(table)
    shown = storage.current(spark, path)
    kept = shown.buckets if shown else None
    if kept and buckets and kept != buckets:
        raise BucketError(f"{table} has {kept} buckets, not {buckets}")
    count = kept or buckets or BUCKETS
    state = zones.read_or_none(table)
    touched = None
    if kept and not set(incoming.columns) - set(state.columns):
        touched = _touched(incoming, deletes, key, count)
        if not touched:
            return
        state = _buckets(zones, shown, touched)
    # Otherwise a first load, or new columns that every file has to get.
    # The buckets hold each key once; a table that comes from elsewhere may not.
    settled = unique and (kept or state is None)
    if settled and timestamp not in {*incoming.columns, *(state.columns if state else [])}:
        new = null_columns_to_string(replace_keys(state, incoming, deletes, key))
    else:
        old = apply_deletes(state, deletes, key) if deletes is not None else state
        new = null_columns_to_string(upsert(old, incoming, key, timestamp, arrival))
    folder = storage.new_version(path)
    schema = new.schema
    seen = Observation()
    marked = new.withColumn(BUCKET, bucket_of(key, count)).observe(
        seen, F.collect_set(BUCKET).alias("written")
    )
    marked.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
    parts = {b: folder for b in seen.get["written"]}
    if touched is not None:
        parts |= {b: f for b, f in shown.parts.items() if b not in touched}
    storage.show(spark, path, storage.Shown(schema, buckets=count, parts=parts))


def _touched(
    incoming: DataFrame, deletes: DataFrame | None, key: str, buckets: int
) -> set[int]:
    """Numbers of the buckets that a batch falls into, ``buckets`` at most."""
    changed = incoming.select(F.col(key).cast("string").alias(key))
    if deletes is not None:
        kind = incoming.schema[key].dataType
        changed = changed.unionByName(
            deletes.select(F.col(key).cast(kind).cast("string").alias(key))
        )
    found = changed.where(F.col(key).isNotNull()).select(bucket_of(key, buckets).alias("b"))
    return {row["b"] for row in found.distinct().collect()}


def _buckets(zones: Warehouse, shown: storage.Shown, wanted: set[int]) -> DataFrame:
    own = {b: f for b, f in shown.parts.items() if b in wanted}
    return storage.read_shown(zones.spark, replace(shown, parts=own))
