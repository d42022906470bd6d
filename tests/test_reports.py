from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwright.operators import aggregates, joins, ordering, sets, vectors, windows
from tillwright.plans import adhoc, monitoring


def test_chronological_or_text(spark):
    days = spark.createDataFrame([("2024-10-1",), ("2024-9-30",)], "d string")
    assert [r[0] for r in ordering.sort_chronologically(days, "d").collect()] == ["2024-9-30", "2024-10-1"]
    mixed = days.union(spark.createDataFrame([("later",)], "d string"))
    got = [r[0] for r in ordering.sort_chronologically(mixed, "d").collect()]
    assert got == ["2024-10-1", "2024-9-30", "later"]


@pytest.mark.parametrize("n", [12, 13])
def test_other(spark, n):
    df = spark.range(1, n + 1).selectExpr("CAST(id AS STRING) AS k", "CAST(id AS DOUBLE) AS v")
    got = dict(rows(ordering.top_with_other(df, "k", "v")))
    if n == 12:
        assert len(got) == 12 and "Other" not in got
    else:
        assert len(got) == 11 and got["Other"] == 1.0 + 2.0 + 3.0


def test_other_of_zero_is_left_out(spark):
    df = spark.range(20).selectExpr(
        "CAST(id AS STRING) AS k", "CASE WHEN id < 10 THEN 1.0D ELSE 0.0D END AS v"
    )
    assert len(rows(ordering.top_with_other(df, "k", "v"))) == 10


def test_measure_leaves_out_text_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", "1.5"), ("a", "x"), ("a", None), (None, "2"), ("b", "NaN"), ("a", "2")],
        "k string, m string",
    )
    assert rows(aggregates.measure_by(df, "k", "m")) == [("a", 3.5)]
    tiny = spark.range(1000).selectExpr("'a' AS k", "1e-7 AS m")
    assert abs(aggregates.measure_by(tiny, "k", "m").first()["m"] - 1e-4) < 1e-12


def test_daily_summary_keeps_orders_without_day(spark):
    df = spark.createDataFrame(
        [("1", None, 2, 1.0), ("1", None, 1, 1.0), ("2", date(2024, 1, 1), 1, 0.5)],
        "order_id string, order_date date, quantity bigint, total_amount double",
    )
    assert rows(aggregates.order_summary_daily(df)) == sorted(
        [(None, 1, 3, 2.0), (date(2024, 1, 1), 1, 1, 0.5)], key=repr
    )


RUN = "run_id bigint, job_name string, processing_status string, ingestion_time timestamp, record_count bigint, rejected_count bigint, processing_time double, error_message string, data_quality_failures bigint"


def runs(spark):
    at = datetime(2024, 1, 10)
    return spark.createDataFrame(
        [
            (1, "a", "SUCCESS", at, 10, 0, 1.0, None, 0),
            (2, "a", "FAILED", at, 5, 5, 2.0, "x" * 3000, 5),
            (3, "b", "SUCCESS", datetime(2024, 1, 1), 10, 1, 3.0, "", 0),
        ],
        RUN,
    )


def test_kpis(spark):
    assert tuple(aggregates.run_kpis(runs(spark)).first()) == (3, 2 / 3 * 100.0, 1, 25, 6, 2.0)
    assert tuple(aggregates.run_kpis(runs(spark).limit(0)).first()) == (0, 0.0, 0, 0, 0, 0.0)


def test_run_selection(spark):
    now = datetime(2024, 1, 12)
    assert monitoring.select_runs(runs(spark), statuses=[]).count() == 0
    assert monitoring.select_runs(runs(spark), jobs=["a"], days=7, now=now).count() == 2
    assert monitoring.select_runs(runs(spark)).count() == 3


def test_events(spark):
    events = monitoring.derive_events(runs(spark))
    assert rows(events, "run_id", "severity", "event_type") == [
        (1, "INFO", "PIPELINE_RUN"),
        (2, "ERROR", "PIPELINE_ERROR"),
        (2, "ERROR", "PIPELINE_RUN"),
        (2, "WARNING", "DATA_QUALITY"),
        (3, "WARNING", "PIPELINE_RUN"),
    ]
    error = events.filter("event_type = 'PIPELINE_ERROR'").first()
    assert len(error["message"]) == 3000
    cut_off = monitoring.derive_events(runs(spark), 2000).filter("event_type = 'PIPELINE_ERROR'")
    assert len(cut_off.first()["message"]) == 2000
    assert monitoring.select_events(events, []).count() == 0


def test_record_run(spark, folder):
    monitoring.record_run(
        spark, folder, run_id=7, file_name="f", source="s", record_count=3, valid_count=2,
        rejected_count=1, processing_time=0.12345, job_name="j", pipeline_version="1",
    )
    run = spark.read.parquet(f"{folder}/pipeline_runs").first()
    assert (run["processing_status"], run["processing_time"]) == ("PARTIAL", 0.123)
    assert spark.read.parquet(f"{folder}/pipeline_events").count() == 1
    assert [monitoring.run_status(*x) for x in ((1, 0), (1, 1), (0, 1))] == [
        "SUCCESS", "PARTIAL", "FAILED",
    ]


def test_nearest_against_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(vectors, "STORE_BLOCK", 100)
    monkeypatch.setattr(vectors, "PROBE_BLOCK", 30)
    chance = random.Random(5)
    points = [(i, [chance.random() for _ in range(6)]) for i in range(300)]
    kind = "embedding array<float>"
    df = spark.createDataFrame(points, f"vec_id bigint, {kind}").repartition(7)
    probes = [(0, points[0][1]), *((i, [chance.random() for _ in range(6)]) for i in range(1, 65))]
    asked = spark.createDataFrame(probes, f"probe_id bigint, {kind}")
    got = {}
    for r in vectors.nearest(df, asked, 4).collect():
        got.setdefault(r["probe_id"], []).append((r["position"], r["vec_id"]))
    assert len(got) == 65
    for probe_id, probe in probes:
        by_distance = sorted(points, key=lambda p: sum((a - b) ** 2 for a, b in zip(p[1], probe, strict=True)))
        assert [v for _, v in sorted(got[probe_id])] == [p[0] for p in by_distance[:4]]
    assert vectors.nearest(df, asked, 0).count() == 65
    assert vectors.nearest(df, asked.limit(0), 3).count() == 0
    uneven = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0]), (3, [4.0, 5.0, 6.0])], f"vec_id bigint, {kind}")
    with pytest.raises(Exception, match="differ in length"):
        vectors.nearest(uneven, asked, 1).collect()


def test_adhoc_is_capped_and_read_only(spark):
    tables = {"numbers": spark.range(1000).withColumnRenamed("id", "n")}
    assert adhoc.run_sql(spark, "SELECT n FROM numbers;", tables).count() == 500
    for bad in ("DROP VIEW numbers", "SELECT 1; SELECT 2", "SELECT nope FROM numbers"):
        with pytest.raises(Exception):
            adhoc.run_sql(spark, bad, tables)


def test_union_relaxed_types(spark):
    a = spark.createDataFrame([(1, date(2024, 1, 1), 1)], "n int, d date, x int")
    b = spark.createDataFrame([(2.5, datetime(2024, 1, 1), "q")], "n double, d timestamp, x string")
    assert sets.union_relaxed(a, b).dtypes == [("n", "double"), ("d", "timestamp"), ("x", "string")]


def test_broadcast_only_within_the_cap(spark, folder):
    spark.range(1000).write.parquet(folder)
    stored = spark.read.parquet(folder)
    size = joins.stored_bytes(stored)
    assert size > 1000
    shown = [
        joins.hinted(stored, mb)._jdf.queryExecution().logical().toString()
        for mb in (100, size / 2**20 / 2, None)
    ]
    assert ["broadcast" in text for text in shown] == [True, False, False]


def test_contribution(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "g string, v double")
    shared = windows.contribution(windows.contribution(df, "v", ["g"], "in_group"), "v")
    assert rows(shared, "g", "in_group", "contribution_percent") == sorted(
        [("a", 25.0, 25.0), ("a", 75.0, 75.0), ("b", None, 0.0)], key=repr
    )


def test_diff_treats_null_as_equal_to_null(spark):
    old = spark.createDataFrame([(1, None), (2, None), (3, "x")], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, "y"), (3, None), (4, "z")], "k int, v string")
    assert rows(joins.snapshot_diff(new, old, "k", ["v"]), "k", "change") == [
        (1, "unchanged"), (2, "changed"), (3, "changed"), (4, "new"),
    ]


def test_as_of_bounds_are_inclusive(spark):
    versions = spark.createDataFrame(
        [(1, "a", date(2024, 1, 2), date(2024, 1, 3))],
        "vk int, id string, effective_from date, effective_to date",
    )
    days = spark.createDataFrame([("a", date(2024, 1, d)) for d in (1, 2, 3, 4)], "id string, d date")
    got = joins.as_of_version(days, versions, "id", "d", ["vk"])
    assert rows(got, "d") == [(date(2024, 1, 2),), (date(2024, 1, 3),)]


def test_top_per_group(spark):
    df = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 1 END AS g", "id AS v")
    got = windows.top_per_group(df, ["g"], [F.col("v").desc()], 2)
    hot = [r["v"] for r in got.filter("g = 1").orderBy("rank_in_group").collect()]
    assert hot == [299, 298]
