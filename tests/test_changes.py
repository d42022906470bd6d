from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwright.operators import upsert
from tillwright.operators.windows import keep_last
from tillwright.plans import curate
from tillwright.plans.state import BucketError, apply_changes
from tillwright.schemas import SchemaError
from tillwright.sources.tables import Warehouse
from tillwright.streaming import ingest, ledger

T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))
TIMED = "customer_id string, updated_at timestamp, v string"


def timed(spark, *records):
    return spark.createDataFrame(records, TIMED)


def test_latest_timestamp_wins(spark):
    old = timed(spark, ("1", T2, "old"), ("2", T2, "old"), ("3", T2, "old"), ("4", None, "old"), ("5", T1, "old"))
    new = timed(
        spark, (" 1 ", T1, "older"), ("2", T2, "tie"), ("3", T3, "newer"), ("4", None, "null tie"),
        ("5", None, "null"), ("6", T1, "insert"), (None, T3, "no key"),
    )
    assert rows(upsert.upsert(old, new, "customer_id"), "customer_id", "v") == [
        ("1", "old"), ("2", "tie"), ("3", "newer"), ("4", "null tie"), ("5", "old"), ("6", "insert"),
    ]


def test_incoming_wins_without_timestamp(spark):
    old = spark.createDataFrame([("1", "z"), ("2", "b")], "order_id string, v string")
    new = spark.createDataFrame([(1, "a"), (3, "c")], "order_id int, v string")
    assert rows(upsert.upsert(old, new, "order_id")) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_text_timestamps(spark):
    new = spark.createDataFrame(
        [("1", "2024-01-02", "late"), ("1", "unknown", "bad"), ("1", "2024-01-01", "early")],
        "customer_id string, updated_at string, v string",
    )
    assert rows(upsert.upsert(None, new, "customer_id"), "v") == [("late",)]


def test_columns_evolve(spark):
    old = spark.createDataFrame([("1", "x", 5)], "order_id string, gone string, n int")
    new = spark.createDataFrame([("2", 6, True)], "order_id string, n int, fresh boolean")
    state = upsert.upsert(old, new, "order_id")
    assert state.columns == ["order_id", "gone", "n", "fresh"]
    assert rows(state) == [("1", "x", 5, None), ("2", None, 6, True)]


def test_empty_batch(spark):
    old = timed(spark, ("1", T1, "a"))
    assert rows(upsert.upsert(old, old.limit(0), "customer_id"), "v") == [("a",)]


def test_missing_key(spark):
    df = spark.createDataFrame([(1,)], "k int")
    good = spark.createDataFrame([(1,)], "order_id int")
    with pytest.raises(SchemaError):
        upsert.upsert(None, df, "order_id")
    with pytest.raises(SchemaError):
        upsert.upsert(df, good, "order_id")


def test_deletes(spark):
    old = spark.createDataFrame([(" 1", "a"), ("2", "b")], "order_id string, v string")
    gone = spark.createDataFrame([("1 ",), (None,)], "order_id string")
    assert rows(upsert.apply_deletes(old, gone, "order_id"), "v") == [("b",)]
    assert upsert.apply_deletes(None, gone, "order_id") is None
    assert upsert.apply_deletes(old, gone, "other") is old


def test_counts(spark):
    old = spark.createDataFrame([("1",), ("2",)], "order_id string")
    new = spark.createDataFrame([("2",), ("3",), ("3",), (None,)], "order_id string")
    assert rows(upsert.upsert_counts(old, new, "order_id")) == [(1, 1)]
    assert rows(upsert.upsert_counts(None, new, "order_id")) == [(2, 0)]


def test_hot_key_same_result_at_any_width(spark):
    """One key holds most rows; the survivor does not depend on partitioning."""
    records = [(1 if i % 3 else i, i % 7, i) for i in range(3000)]
    df = spark.createDataFrame(records, "k int, ts int, v int")
    expected = {}
    for k, ts, v in records:
        expected[k] = max(expected.get(k, (-1, -1)), (ts, v))
    for width in (1, 7):
        got = keep_last(df.repartition(width), ["k"], ["ts"])
        assert {r["k"]: (r["ts"], r["v"]) for r in got.collect()} == expected


def test_job_delete_and_insert_in_one_batch(spark, folder):
    zones = Warehouse(spark, folder)
    spark.createDataFrame([("1",)], "customer_id string").write.parquet(zones.path("curated/customers"))
    spark.createDataFrame([("10",)], "product_id string").write.parquet(zones.path("curated/products"))
    from test_quality import orders

    first = orders(spark, *[(i, "1", "10", "2024-01-05", "1", "1") for i in "1234"])
    assert curate.load_orders(zones, first, batch="1") == 4
    second = orders(
        spark,
        ("1", "1", "10", "2024-01-05", "1", "1", "DELETE"),
        ("2", "1", "10", "2024-01-05", "1", "1", "d"),
        ("2", "1", "10", "2024-01-06", "9", "1"),
        ("5", "7", "10", "2024-01-05", "1", "1"),
    )
    assert curate.load_orders(zones, second, batch="2") == 1
    assert rows(zones.read("curated/orders"), "order_id", "quantity") == [("2", 9), ("3", 1), ("4", 1)]
    assert rows(zones.read("quarantine/orders"), "order_id", "batch") == [(5, 2)]
    # The same batch again, after a failure, leaves the same rows.
    curate.load_orders(zones, second, batch="2")
    assert zones.read("curated/orders").count() == 3
    assert zones.read("quarantine/orders").count() == 1


def test_deleting_everything_leaves_an_empty_state(spark, folder):
    zones = Warehouse(spark, folder)
    spark.createDataFrame([("1",)], "customer_id string").write.parquet(zones.path("curated/customers"))
    spark.createDataFrame([("10",)], "product_id string").write.parquet(zones.path("curated/products"))
    from test_quality import orders

    curate.load_orders(zones, orders(spark, ("1", "1", "10", "2024-01-05", "1", "1")))
    curate.load_orders(zones, orders(spark, ("1", "1", "10", "2024-01-05", "1", "1", "DELETE")))
    assert zones.read("curated/orders").count() == 0
    assert not zones.has("quarantine/orders")


def test_unknown_dataset(spark, folder):
    with pytest.raises(ValueError, match="unknown dataset"):
        curate.load(Warehouse(spark, folder), "stores", None)


def test_ledger(spark, folder):
    files = spark.createDataFrame(
        [("d", "a.csv", T1, 10), ("d", "b.csv", T2, 20)],
        "dataset string, path string, modified_time timestamp, size bigint",
    )
    changed = spark.createDataFrame(
        [("d", "a.csv", T1, 10), ("d", "b.csv", T2, 21), ("d", "c.csv", T3, 5)], files.schema
    )
    assert ledger.new_or_changed(files, None).count() == 2
    known = files.withColumn("processed_at", F.lit(T3))
    assert rows(ledger.new_or_changed(changed, known), "path") == [("b.csv",), ("c.csv",)]
    assert rows(ledger.new_paths(changed, known), "path") == [("c.csv",)]


def test_watermark(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    none = df.limit(0)
    assert rows(ledger.after_watermark(df, "n", df.filter("n = 1"))) == [(2,)]
    assert rows(ledger.after_watermark(df, "n", None, 0)) == [(1,), (2,)]
    assert rows(ledger.after_watermark(df, "n", none, 1)) == [(2,)]
    assert rows(ledger.after_watermark(df, "n", df.filter("n = 1"), 9)) == [(2,)]
    for state in (None, none):
        with pytest.raises(Exception, match="start from"):
            ledger.after_watermark(df, "n", state).collect()


def test_ledger_compares_with_the_latest_entry(spark, folder):
    """A file that is changed and then put back counts as changed both times."""
    zones = Warehouse(spark, folder)
    old, new = [
        spark.createDataFrame([("d", "a.csv", datetime(2024, 1, day), size)], "dataset string, path string, modified_time timestamp, size bigint")
        for day, size in ((1, 10), (2, 20))
    ]
    for run, files in enumerate((old, new, old)):
        assert ledger.new_or_changed(files, ledger.read_ledger(zones)).count() == 1
        ledger.mark_processed(zones, files, f"2024-02-0{run + 1} 00:00:00", records=run)
        assert ledger.new_or_changed(files, ledger.read_ledger(zones)).count() == 0
    state = ledger.ledger_state(ledger.read_ledger(zones)).first()
    assert (state["files"], state["bytes"], state["last_records"]) == (1, 10, 2)


def test_bucket_count_stays_with_the_table(spark, folder):
    zones = Warehouse(spark, folder)
    rows_of = lambda n, at: spark.range(n).select(
        F.col("id").cast("string").alias("k"), F.lit(at).cast("timestamp").alias("updated_at")
    )
    apply_changes(zones, "t", "k", rows_of(100, "2024-01-01"), buckets=64)
    with pytest.raises(BucketError):
        apply_changes(zones, "t", "k", rows_of(50, "2024-01-02"), buckets=8)
    apply_changes(zones, "t", "k", rows_of(50, "2024-01-02"))
    found = zones.read("t")
    assert found.count() == 100 and "key_bucket" not in found.columns
    assert found.filter("updated_at = '2024-01-02'").count() == 50


def test_stream_refuses_another_schema(spark, folder):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{folder}/one")
    spark.createDataFrame([("x",)], "a string").write.parquet(f"{folder}/two")
    for name, kind in (("one", "a int"), ("two", "a string")):
        schema = spark.createDataFrame([], kind).schema
        stream = ingest.parquet_stream(spark, f"{folder}/{name}", schema)
        if name == "one":
            ingest.append_load(stream, f"{folder}/table", f"{folder}/cp-{name}")
        else:
            with pytest.raises(Exception, match="a: string instead of int"):
                ingest.append_load(stream, f"{folder}/table", f"{folder}/cp-{name}")
    assert spark.read.parquet(f"{folder}/table").count() == 1


def test_stream_restart_reads_nothing_twice(spark, folder):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    df.write.parquet(f"{folder}/in")
    for _ in range(2):
        stream = ingest.parquet_stream(spark, f"{folder}/in", df.schema)
        ingest.append_load(stream, f"{folder}/out", f"{folder}/cp")
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_buckets_give_the_same_state_and_spare_the_rest(spark, folder):
    from tillwright.plans.state import apply_changes

    def batch(ids, v):
        return spark.createDataFrame([(str(i), v) for i in ids], "order_id string, v string")

    zones = Warehouse(spark, folder)
    steps = [
        (batch(range(200), "a"), None),
        (batch([3, 500], "b"), batch([4, 5], "").select("order_id")),
        (batch([], "c"), batch([3], "").select("order_id")),
    ]
    files = []
    for incoming, deletes in steps:
        apply_changes(zones, "whole", "order_id", incoming, deletes)
        apply_changes(zones, "parts", "order_id", incoming, deletes, buckets=64)
        files.append(set(zones.read("parts").inputFiles()))
        assert rows(zones.read("parts").drop("key_bucket")) == rows(zones.read("whole"))
    assert len(files[0] & files[1]) >= 60
    assert zones.read("parts").count() == 198
    # Deleting all rows of a bucket empties it; new columns rewrite everything.
    apply_changes(zones, "parts", "order_id", batch([], "d"), batch(range(501), "").select("order_id"), buckets=64)
    assert zones.read_or_none("parts") is None or zones.read("parts").count() == 0
    from pyspark.sql import functions as F

    wider = batch([1], "e").withColumn("w", F.lit(1))
    apply_changes(zones, "parts", "order_id", wider, buckets=64)
    assert rows(zones.read("parts").drop("key_bucket")) == [("1", "e", 1)]


def test_bucketed_job(spark, folder):
    from test_quality import customers

    zones = Warehouse(spark, folder)
    people = [(str(i), "n", f"n{i}@x.com", "smb") for i in range(20)]
    curate.load_customers(zones, customers(spark, *people), at="2024-01-01", buckets=8)
    curate.load_customers(
        zones, customers(spark, ("3", "n", "n3@x.com", "vip")), at="2024-01-02", buckets=8
    )
    state = zones.read("curated/customers")
    assert state.count() == 20
    assert rows(state.filter("customer_segment = 'VIP'"), "customer_id") == [("3",)]
