from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwright.plans import incremental
from tillwright.schemas import SchemaError
from tillwright.sources import files, publish, sinks, storage, tables


def test_path_parts(spark):
    paths = {
        "raw/orders/o.csv": ("orders", None, "o.csv"),
        "raw/orders/2022-01-03/o.CSV": ("orders", "2022-01-03", "o.CSV"),
        "RAW/orders/2022-01-03%20copy/o.csv": ("orders", "2022-01-03 copy", "o.csv"),
        "raw/o.csv": None,
        "raw//o.csv": None,
        "raw/a/b/c/o.csv": None,
        "other/orders/o.csv": None,
        "raw/orders/o.json": None,
    }
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["path"]: tuple(r)[1:] for r in files.parse_paths(df).collect()}
    assert got == {p: v for p, v in paths.items() if v}


def test_csv_keeps_text_and_reads_folders(spark, folder):
    df = spark.createDataFrame([("007", " x "), (None, "y")], "`Order ID` string, name string")
    for part in ("2024-01-01", "2024-01-01 copy"):
        df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(
            f"{folder}/{part}"
        )
    read = files.read_csv_text(spark, folder)
    assert read.dtypes == [("order_id", "string"), ("name", "string")]
    assert rows(read) == sorted([("007", " x "), (None, "y")] * 2, key=repr)


def test_broken_lines_are_kept(spark, folder):
    text = 'Order ID,name,city\n1,a,x\n2,b\n3,c,y,more\n4,"d, e",z\n5,"open,z\n6,f,\n\n,,\n7,"g h",w\n'
    spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(f"{folder}/raw")
    checked = files.read_csv_checked(spark, f"{folder}/raw")
    good, bad = files.split_lines(checked)
    assert good.columns == ["order_id", "name", "city"]
    assert rows(good) == sorted(
        [("1", "a", "x"), ("4", "d, e", "z"), ("6", "f", None), (None, None, None), ("7", "g h", "w")], key=repr
    )
    assert rows(bad, "line") == [("2,b",), ("3,c,y,more",), ('5,"open,z',)]
    assert bad.filter("file LIKE '%/raw/part-%'").count() == 3 and bad.count() == 3
    (counts,) = files.line_counts(checked).collect()
    assert (counts.good_lines, counts.bad_lines) == (5, 3)
    with pytest.raises(ValueError):
        files.read_csv_checked(spark, f"{folder}/raw", header=False)


def test_broken_lines_go_to_quarantine(spark, folder):
    header = "product_id,product_name,category,price,supplier"
    text = header + "\n1,A,x,2.5,s\n2,B,x,3.5\n3,C, with a comma,x,1,s\n4,D,x,oops,s"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/raw/products")
    spark.createDataFrame([("keep",)], "value string").write.text(f"{folder}/other")
    paths = spark.read.format("binaryFile").load(f"{folder}/raw/products/part-*").select("path").collect()
    for row in paths:  # the ledger lists CSV files
        fs = storage._fs(spark, row.path)
        fs.rename(storage._path(spark, row.path), storage._path(spark, row.path.replace(".txt", ".csv")))
    (load,) = incremental.run(spark, f"{folder}/raw", f"{folder}/lake", "2024-02-01 06:00:00")
    assert (load.rows, load.broken) == (1, 2)
    zones = tables.Warehouse(spark, f"{folder}/lake")
    assert rows(zones.read("quarantine/products_lines"), "line") == [("2,B,x,3.5",), ("3,C, with a comma,x,1,s",)]
    assert zones.read("quarantine/products").count() == 1
    assert rows(zones.read("curated/products"), "product_id", "product_name") == [("1", "A")]


def test_unknown_format(spark, folder):
    with pytest.raises(ValueError):
        files.read_source(spark, folder, "xml")


def test_append_checked(spark, folder):
    sinks.append_checked(spark.createDataFrame([(1, "a")], "k int, v string"), folder)
    sinks.append_checked(spark.createDataFrame([("b", 2)], "v string, k int"), folder)
    for kind in ("k int", "k int, v string, x int", "k bigint, v string"):
        with pytest.raises(SchemaError):
            sinks.append_checked(spark.createDataFrame([], kind), folder)
    assert rows(spark.read.parquet(folder)) == [(1, "a"), (2, "b")]


def test_refresh_refuses_nothing_and_keeps_the_table(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([(1,)], "k int")
    assert sinks.replace_table(df, path) == 1
    with pytest.raises(ValueError, match="empty"):
        sinks.replace_table(df.limit(0), path)
    assert rows(storage.read_table(spark, path)) == [(1,)]
    assert sinks.replace_table(storage.read_table(spark, path).selectExpr("k + 1 AS k"), path) == 1
    assert rows(storage.read_table(spark, path)) == [(2,)]


def test_failed_refresh_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    sinks.replace_table(spark.createDataFrame([(1,)], "k int"), path)
    broken = spark.range(1).select(F.raise_error(F.lit("broken")).cast("int").alias("k"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(broken, path)
    assert rows(storage.read_table(spark, path)) == [(1,)]


def test_a_load_that_dies_at_any_step_leaves_the_old_or_the_new_state(spark, folder, monkeypatch):
    path = f"{folder}/t"
    for k in range(3):
        sinks.replace_table(spark.createDataFrame([(k,)] * 100, "k int"), path)
    state = [(2,)] * 100
    for number, name in enumerate(["show", "_show", "_selection", "read_shown"]):
        step = getattr(storage, name)

        def die(*args, **kwargs):
            raise KeyboardInterrupt

        monkeypatch.setattr(storage, name, die)
        try:
            sinks.replace_table(spark.createDataFrame([(9 + number,)] * 3, "k int"), path)
        except KeyboardInterrupt:
            pass
        monkeypatch.setattr(storage, name, step)
        found = rows(storage.read_table(spark, path))
        assert found in (state, [(9 + number,)] * 3)
        state = found
    # The next load goes past what the others left, which can be removed.
    sinks.replace_table(spark.createDataFrame([(7,)], "k int"), path)
    assert rows(storage.read_table(spark, path)) == [(7,)]
    assert len(storage.drop_unshown(spark, path)) >= 5
    assert rows(storage.read_table(spark, path)) == [(7,)]
    assert storage.drop_unshown(spark, path) == []


def test_the_catalogue_shows_a_table(spark, folder):
    path = f"{folder}/it's a table"
    days = spark.createDataFrame([("007", date(2024, 1, 5), 1), ("x", None, 2)], "code string, d date, v int")
    sinks.replace_partitioned(days, path, "code", "d")
    view = storage.view_name(spark, path)
    assert dict(spark.table(view).dtypes) == {"code": "string", "d": "date", "v": "int"}
    assert rows(spark.table(view)) == rows(storage.read_table(spark, path)) == rows(days)
    sinks.replace_partitioned(days.limit(0).withColumn("more", F.lit(1.5)), path, "code", "d")
    assert spark.table(view).columns == ["code", "d", "v", "more"] and spark.table(view).count() == 0
    assert storage.read_table(spark, path).count() == 0


def test_a_table_that_the_catalogue_lost_is_not_taken_for_new(spark, folder, monkeypatch):
    path = f"{folder}/t"
    sinks.replace_table(spark.createDataFrame([(1,)], "k int"), path)
    spark.sql(f"DROP VIEW {storage.view_name(spark, path)}")
    # In the process that wrote it, a folder that is not shown is a write that died.
    assert not storage.has_table(spark, path)
    monkeypatch.setattr(storage, "_OWN", set())
    with pytest.raises(LookupError, match="adopt"):
        tables.Warehouse(spark, folder).read_or_none("t")
    storage.adopt(spark, path)
    assert rows(tables.Warehouse(spark, folder).read("t")) == [(1,)]
    with pytest.raises(LookupError):
        storage.adopt(spark, f"{folder}/none")


def test_days_in_month_folders(spark, folder):
    df = spark.createDataFrame([(i, date(2024, 1 + i % 2, 1 + i % 28)) for i in range(60)] + [(99, None)], "k int, d date")
    for grain, folders in (("month", 3), ("day", 29)):
        sinks.write_by_day(df, f"{folder}/{grain}", "d", grain=grain)
        found = storage.read_table(spark, f"{folder}/{grain}")
        assert rows(found, "k", "d") == rows(df)
        parts = {f.split("/")[-2] for f in found.inputFiles()}
        assert len(parts) == folders
    with pytest.raises(ValueError):
        sinks.write_by_day(df, f"{folder}/x", "d", grain="hour")


def test_unfinished_write_is_no_table(spark, folder):
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{folder}/t/_temporary/0")
    assert not storage.has_data(spark, f"{folder}/t")
    assert tables.Warehouse(spark, folder).read_or_none("t") is None


def test_quarantine(spark, folder):
    df = spark.createDataFrame([(1,)], "k int")
    assert sinks.write_quarantine(df.limit(0), folder) == 0
    assert not storage.has_data(spark, folder)
    sinks.write_quarantine(df, folder)
    sinks.write_quarantine(df, folder)
    assert spark.read.parquet(folder).count() == 2


def test_daily_split(spark, folder):
    df = spark.createDataFrame(
        [("1", "2024-1-5"), ("2", "bad"), ("3", "2024-01-06")], "id string, signup_date string"
    )
    assert sinks.split_daily(df, f"{folder}/days") == "signup_date"
    read = spark.read.option("header", True).csv(f"{folder}/days")
    assert rows(read, "id", "signup_date", "day") == [
        ("1", "2024-01-05", date(2024, 1, 5)), ("3", "2024-01-06", date(2024, 1, 6)),
    ]
    assert sinks.split_daily(df.select("id"), f"{folder}/plain") is None
    assert spark.read.option("header", True).csv(f"{folder}/plain").count() == 3


def test_hive_layout(spark, folder):
    df = spark.createDataFrame(
        [(1, date(2024, 3, 7), " a/b ", "X")], "id int, d date, r string, c string"
    )
    sinks.write_hive_layout(df, folder, "d", "r", "c")
    assert storage.has_data(spark, f"{folder}/year=2024/month=03/day=07/region=a_b/category=X")
    path = sinks.hive_path("base/", F.col("d"), F.col("r"))
    assert df.select(path).first()[0] == "base/year=2024/month=03/day=07/region=a_b"
    for bad in ("", " ", ".", ".."):
        with pytest.raises(Exception, match="invalid partition value"):
            df.select(sinks.safe_folder(F.lit(bad))).collect()


def test_export(spark):
    df = spark.createDataFrame(
        [
            (float("nan"), date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), Decimal("1.50"), True,
             ["a"], {"k": 1}, bytearray(b"x"), 7, None),
        ],
        "f double, d date, t timestamp, m decimal(8,2), b boolean, a array<string>, "
        "o map<string,int>, y binary, i bigint, s string",
    )
    assert tuple(publish.relational_form(df).first()) == (
        None, "2024-01-02", "2024-01-02T03:04:05", "1.50", 1, '["a"]', '{"k":1}', bytearray(b"x"), 7, None,
    )


def test_publish_is_all_or_nothing(spark, folder):
    good = spark.createDataFrame([(1,)], "k int")
    assert publish.publish(spark, {"a": good, "b": good.limit(0)}, folder) == {"a": 1, "b": 0}
    broken = spark.range(1).select(F.raise_error(F.lit("broken")).cast("int").alias("k"))
    with pytest.raises(Exception, match="broken"):
        publish.publish(spark, {"a": good.union(good), "b": broken}, folder)
    assert publish.read_published(spark, folder, "a").count() == 1


def test_publish_shows_all_tables_in_one_step(spark, folder, monkeypatch):
    old = {"a": spark.range(7), "b": spark.range(7)}
    publish.publish(spark, old, folder)
    step = storage._show

    def die(*args):
        raise OSError("gone")

    monkeypatch.setattr(storage, "_show", die)
    with pytest.raises(OSError):
        publish.publish(spark, {"a": spark.range(50), "b": spark.range(50)}, folder)
    assert [publish.read_published(spark, folder, n).count() for n in "ab"] == [7, 7]
    monkeypatch.setattr(storage, "_show", step)
    publish.publish(spark, {"b": spark.range(50)}, folder)
    assert [publish.read_published(spark, folder, n).count() for n in "ab"] == [7, 50]


def test_ingest_log(spark, folder):
    kind = "file_name string, record_count bigint, processing_status string, processing_time_seconds double"
    sinks.log_ingestion(spark.createDataFrame([("f", 1, "failed", 1.23456)], kind), folder)
    sinks.log_ingestion(spark.createDataFrame([("g", 0, "SUCCESS", 0.0)], kind), folder)
    found = storage.read_table(spark, folder)
    assert rows(found, "file_name", "processing_status", "processing_time_seconds", "error_count", "source") == [
        ("f", "FAILED", 1.235, 0, None), ("g", "SUCCESS", 0.0, 0, None),
    ]
    for bad in (("f", -1, "FAILED", 1.0), ("f", 1, "FAILED", -1.0), ("f", 1, "DONE", 1.0), ("f", 1, None, 1.0)):
        with pytest.raises(Exception, match="negative|none of"):
            sinks.log_ingestion(spark.createDataFrame([bad], kind), folder)


def test_tables(spark):
    df = spark.range(20)
    assert tables.preview({"t": df}, "t", 0).count() == 1
    assert tables.preview({"t": df}, "t").count() == 10
    with pytest.raises(LookupError):
        tables.preview({"t": df}, "u")
    with pytest.raises(LookupError):
        tables.scan(spark, "no_such_table")


def test_groups_of_different_types(spark, folder):
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(f"{folder}/1/x")
    spark.createDataFrame([(2.5,)], "k double").write.parquet(f"{folder}/2")
    read = files.read_parquet_tree(spark, folder)
    assert dict(read.dtypes)["k"] == "double"
    assert rows(read, "k", "v") == [(1.0, "a"), (2.5, None)]
