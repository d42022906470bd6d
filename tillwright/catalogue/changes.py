"""Incremental loads: ledgers, watermark, upsert, delete, file streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tillwright.catalogue import fragments as s
from tillwright.catalogue.base import query
from tillwright.operators import quality, upsert
from tillwright.operators.windows import keep_last
from tillwright.session import run_dir
from tillwright.sources import bridge
from tillwright.sources.tables import Warehouse
from tillwright.streaming import ingest, keyed, ledger

TEXT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _segment_files(t, path):
    """Raw customers as CSV, one folder per segment."""
    raw = bridge.raw_customers(t).withColumn("segment", F.col("customer_segment"))
    raw.hint("rebalance", "segment").write.options(**TEXT).partitionBy("segment").csv(path)


def _folder(files):
    return files.select(F.regexp_extract("path", r"segment=([^/]+)/", 1).alias("segment"))


@query(
    "inc_file_ledger",
    """SELECT DISTINCT lower(c_mktsegment) AS segment, 1 AS run FROM customer
    UNION ALL SELECT 'building', 2""",
)
def file_ledger(t):
    """All files are new at first; after one folder is written again only it is."""
    base = run_dir(t.spark, "ledger")
    folder, warehouse = f"{base}/raw", Warehouse(t.spark, f"{base}/warehouse")
    _segment_files(t, folder)
    first = ledger.new_or_changed(
        ledger.list_files(t.spark, folder, "customers"), ledger.read_ledger(warehouse)
    )
    ledger.mark_processed(warehouse, first)
    known = ledger.read_ledger(warehouse)
    again = bridge.raw_customers(t).filter("customer_segment = 'building'")
    again.write.options(**TEXT).mode("overwrite").csv(f"{folder}/segment=building")
    second = ledger.new_or_changed(ledger.list_files(t.spark, folder, "customers"), known)
    runs = [
        _folder(df).distinct().withColumn("run", F.lit(i)) for i, df in ((1, known), (2, second))
    ]
    return runs[0].unionByName(runs[1])


@query(
    "inc_path_ledger",
    "SELECT DISTINCT lower(c_mktsegment) AS segment FROM customer WHERE c_mktsegment <> 'BUILDING'",
)
def path_ledger(t):
    """Paths of one folder are known, though their recorded size and time are others."""
    base = run_dir(t.spark, "paths")
    _segment_files(t, f"{base}/raw")
    files = ledger.list_files(t.spark, f"{base}/raw", "customers")
    known = files.filter(F.col("path").startswith("segment=building/")).withColumn(
        "size", F.col("size") + 1
    )
    return _folder(ledger.new_paths(files, known)).distinct()


@query(
    "inc_mark_processed",
    """SELECT 'customers' AS dataset, count(DISTINCT c_mktsegment) AS segments,
           count(*) AS last_records, TIMESTAMP '2024-02-01 06:00:00' AS last_run,
           TRUE AS complete FROM customer""",
)
def mark_processed(t):
    """The ledger holds every listed file with its size, marked once with the run's rows."""
    base = run_dir(t.spark, "marked")
    warehouse = Warehouse(t.spark, f"{base}/warehouse")
    _segment_files(t, f"{base}/raw")
    files = ledger.list_files(t.spark, f"{base}/raw", "customers")
    rows = t.spark.read.options(**TEXT).csv(f"{base}/raw").count()
    ledger.mark_processed(
        warehouse, ledger.oldest_first(files), "2024-02-01 06:00:00", records=rows
    )
    book = ledger.read_ledger(warehouse)
    listed = files.groupBy("dataset").agg(F.count("path").alias("n"), F.sum("size").alias("b"))
    complete = (F.col("files") == F.col("n")) & (F.col("bytes") == F.col("b"))
    segments = book.groupBy("dataset").agg(
        F.count_distinct(F.regexp_extract("path", r"segment=([^/]+)/", 1)).alias("segments")
    )
    return (
        ledger.ledger_state(book)
        .join(listed, "dataset")
        .join(segments, "dataset")
        .select("dataset", "segments", "last_records", "last_run", complete.alias("complete"))
    )


@query(
    "inc_watermark",
    """SELECT event_id, ts FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')""",
)
def watermark(t):
    events = t.events.select("event_id", "ts")
    return ledger.after_watermark(events, "ts", events.filter("ts < TIMESTAMP_NTZ '2024-01-15'"))


@query(
    "inc_upsert",
    """WITH both_sides AS (
      SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS updated_at, value, NULL AS event_type,
             0 AS side FROM events WHERE ts < TIMESTAMP '2024-01-15'
      UNION ALL
      SELECT CAST(user_id AS VARCHAR), ts, value, event_type, 1 FROM events
      WHERE ts >= TIMESTAMP '2024-01-10' AND event_type <> 'error')
    SELECT user_id, updated_at, value, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, side DESC) AS rn
      FROM both_sides) WHERE rn = 1""",
)
def inc_upsert(t):
    """Overlapping batches; the incoming one has a new column and may be older."""
    changes = bridge.user_changes(t)
    old = changes.filter("updated_at < TIMESTAMP_NTZ '2024-01-15'").select(
        "user_id", "updated_at", "value"
    )
    new = changes.filter(
        "updated_at >= TIMESTAMP_NTZ '2024-01-10' AND event_type <> 'error'"
    ).select("user_id", "updated_at", "value", "event_type")
    return upsert.upsert(old, new, "user_id")


@query(
    "inc_upsert_counts",
    """WITH o AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < DATE '1996-01-01'),
    n AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= DATE '1996-01-01')
    SELECT count(*) FILTER (k NOT IN (SELECT k FROM o)) AS inserted,
           count(*) FILTER (k IN (SELECT k FROM o)) AS matched FROM n""",
)
def upsert_counts(t):
    orders = t.orders.select(F.col("o_custkey").alias("customer_id"), "o_orderdate")
    return upsert.upsert_counts(
        orders.filter("o_orderdate < DATE '1996-01-01'"),
        orders.filter("o_orderdate >= DATE '1996-01-01'"),
        "customer_id",
    )


@query(
    "inc_delete",
    """SELECT user_id, updated_at, value FROM (
      SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS updated_at, value,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, value DESC) AS rn
      FROM events WHERE ts < TIMESTAMP '2024-01-28')
    WHERE rn = 1 AND user_id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events
      WHERE ts >= TIMESTAMP '2024-01-28' AND event_type = 'error')""",
)
def inc_delete(t):
    changes = bridge.user_changes(t)
    early = changes.filter("updated_at < TIMESTAMP_NTZ '2024-01-28'")
    state = keep_last(early.select("user_id", "updated_at", "value"), ["user_id"], ["updated_at"])
    late = changes.filter("updated_at >= TIMESTAMP_NTZ '2024-01-28'")
    return upsert.apply_deletes(state, quality.split_deletes(late)[1], "user_id")


WEEKS = ("2024-01-09", "2024-01-17", "2024-01-25")


def _week(df, i, column):
    """The i-th arrival; the first and the last have open ends, nulls come last."""
    number = F.lit(len(WEEKS))
    for k in reversed(range(len(WEEKS))):
        number = F.when(F.col(column) < F.lit(WEEKS[k]).cast("timestamp_ntz"), k).otherwise(number)
    return df.filter(number == i)


# Deletes of a week leave the state of the weeks before; the other records of the
# same week are then upserted. So a user's row survives if its week has a load
# record, or if no later week has a delete record.
STREAM_SQL = f"""WITH e AS (
      SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS updated_at, event_type, value,
             CASE {' '.join(f"WHEN ts < TIMESTAMP '{d}' THEN {i}" for i, d in enumerate(WEEKS))}
             ELSE {len(WEEKS)} END AS week FROM events),
    loads AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC,
                event_type DESC, value DESC) AS rn FROM e WHERE event_type <> 'error'),
    gone AS (SELECT user_id, max(week) AS week FROM e WHERE event_type = 'error' GROUP BY user_id)
    SELECT l.user_id, l.updated_at, l.event_type, l.value
    FROM loads l LEFT JOIN gone g USING (user_id)
    WHERE rn = 1 AND (g.week IS NULL OR g.week <= l.week)"""


@query("inc_upsert_stream", STREAM_SQL)
def upsert_stream(t):
    """Four weekly arrivals of change records, each run through the same stream."""
    base = run_dir(t.spark, "upsert-stream")
    warehouse = Warehouse(t.spark, f"{base}/warehouse")
    changes = bridge.user_changes(t)
    for i in range(len(WEEKS) + 1):
        _week(changes, i, "updated_at").write.mode("append").parquet(f"{base}/arrivals")
        stream = ingest.parquet_stream(t.spark, f"{base}/arrivals", changes.schema)
        ingest.upsert_load(stream, warehouse, "users", "user_id", f"{base}/checkpoint")
    return warehouse.read("users").drop("operation")


@query("inc_upsert_stream_state", STREAM_SQL)
def upsert_stream_state(t):
    """The same four arrivals through a stream that keeps the users as its state."""
    base = run_dir(t.spark, "keyed-stream")
    changes = bridge.user_changes(t)
    for i in range(len(WEEKS) + 1):
        _week(changes, i, "updated_at").write.mode("append").parquet(f"{base}/arrivals")
        stream = ingest.parquet_stream(t.spark, f"{base}/arrivals", changes.schema)
        keyed.keyed_load(stream, f"{base}/log", f"{base}/checkpoint", "user_id")
    return keyed.read_keyed(t.spark, f"{base}/log", "user_id").drop("operation")


@query(
    "inc_new_file_trigger",
    f"""WITH {s.RAW_CUSTOMERS} SELECT * FROM raw_c""",
)
def new_file_trigger(t):
    """CSV files arrive in two lots; each run of the stream takes only what is new."""
    base = run_dir(t.spark, "trigger")
    raw = bridge.raw_customers(t)
    segments = F.col("customer_segment").isin("building", "machinery")
    for lot in (raw.filter(segments), raw.filter(~segments)):
        lot.write.options(**TEXT).mode("append").csv(f"{base}/raw")
        stream = ingest.csv_stream(t.spark, f"{base}/raw", raw.columns)
        ingest.append_load(stream, f"{base}/table", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/table").drop("batch")


@query("inc_append_load", "SELECT event_id, ts, user_id, event_type, value FROM events")
def append_load(t):
    """The first lot creates the table, later lots are appended, none is read twice."""
    base = run_dir(t.spark, "append-load")
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    for i in range(len(WEEKS) + 1):
        _week(events, i, "ts").write.mode("append").parquet(f"{base}/arrivals")
        stream = ingest.parquet_stream(t.spark, f"{base}/arrivals", events.schema)
        ingest.append_load(stream, f"{base}/table", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/table").drop("batch")


@query(
    "st_schema_evolution",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total,
              CAST(NULL AS VARCHAR) AS priority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_custkey, NULL, o_orderpriority FROM orders
    WHERE o_orderstatus <> 'F'""",
)
def schema_evolution(t):
    """Old side lacks a column, new side lacks another; old column order is kept."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderstatus",
    )
    old = orders.filter("o_orderstatus = 'F'").select("order_id", "customer_id", "total")
    new = orders.filter("o_orderstatus <> 'F'").select("order_id", "customer_id", "priority")
    return reduce(lambda a, b: a.unionByName(b), upsert.align(old, new))
