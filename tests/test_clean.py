from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions import dates, money, text
from tillwright.operators import clean
from tillwright.schemas import SchemaError, require_columns, schema_differences, validate_schema


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Order ID", "unit-Price ", "x"])
    assert clean.clean_names(df).columns == ["order_id", "unit_price", "x"]


def test_colliding_names(spark):
    with pytest.raises(SchemaError):
        clean.clean_names(spark.createDataFrame([(1, 2)], ["a b", "A-B"]))


def test_required_and_validated(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert require_columns(df, ["a"]) is df
    with pytest.raises(SchemaError, match="no column d, c in input"):
        require_columns(df, ["a", "d", "c"])
    assert validate_schema(df, "a INT", extra=True) is df
    with pytest.raises(SchemaError, match="b: string instead of absent"):
        validate_schema(df, "a INT")
    found = schema_differences(
        T.StructType.fromDDL("a int, b string"), T.StructType.fromDDL("a bigint, z string")
    )
    assert [str(d) for d in found] == [
        "a: int instead of bigint", "z: absent instead of string", "b: string instead of absent",
    ]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2026-01-05", date(2026, 1, 5)),
        (" 2026-1-5 ", date(2026, 1, 5)),
        ("2026-01-05 10:00:00", date(2026, 1, 5)),
        ("2026-01-05T10:00:00", date(2026, 1, 5)),
        ("2026-13-05", None),
        ("2026-02-30", None),
        ("2026-01", None),
        ("2026", None),
        ("2026-01-05 soon", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_day(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(dates.parse_day("v")).first()[0] == expected


@pytest.mark.parametrize(
    ("value", "whole", "number"),
    [
        ("12", 12, 12.0),
        (" -7 ", -7, -7.0),
        ("12.7", None, 12.7),
        ("many", None, None),
        ("NaN", None, None),
        ("99999999999999999999", None, 1e20),
        ("", None, None),
        (None, None, None),
    ],
)
def test_numbers(spark, value, whole, number):
    df = spark.createDataFrame([(value,)], "v string")
    got = df.select(text.whole_number("v"), text.decimal_number("v")).first()
    assert tuple(got) == (whole, number)


@pytest.mark.parametrize(
    ("value", "expected"),
    [(1.005, 1.01), (2.675, 2.68), (0.125, 0.13), (-0.125, -0.13), (10.0, 10.0),
     (1000000.125, 1000000.13), (1.004999, 1.0), (None, None)],
)
def test_round2(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(money.round2("v")).first()[0] == expected


def test_totals_round_once(spark):
    def sums(values, places=2):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(money.money_sum("v", places)).first()[0]

    assert sums([0.004] * 1000) == 4.0
    assert sums([1.005]) == 1.01 and sums([-1.005]) == -1.01
    assert sums([1.0, float("nan"), None, 2.25]) == 3.25
    assert sums([1e17, 1e17]) == 2e17 and sums([]) is None
    one = spark.createDataFrame([(1.005,), (-1.005,)], "v double")
    assert [r[0] for r in one.select(money.round2("v")).collect()] == [1.01, -1.01]


def test_percent(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(money.percent("a", "b")).collect()] == [25.0, None, None]


def test_index_and_empty_columns(spark):
    df = spark.createDataFrame([(1, 2, None, 4)], "`Unnamed: 0` int, __index int, e double, k int")
    df = clean.drop_index_columns(df).withColumn("n", F.lit(None))
    assert clean.null_columns_to_string(df).dtypes[-1] == ("n", "string")
    assert dict(clean.empty_columns_to_string(df).dtypes) == {"e": "string", "k": "int", "n": "string"}


def test_customer_name(spark):
    assert clean.accept_customer_name(spark.createDataFrame([("x",)], "name string")).columns == [
        "customer_name"
    ]
    with pytest.raises(SchemaError):
        clean.accept_customer_name(spark.createDataFrame([("x",)], "label string"))


def test_enriched_casts_only_what_exists(spark):
    df = clean.cast_enriched(spark.createDataFrame([("1", "2.5")], "order_id string, quantity string"))
    assert df.dtypes == [("order_id", "bigint"), ("quantity", "double")]
    with pytest.raises(SchemaError):
        clean.cast_enriched(spark.createDataFrame([("1",)], "quantity string"))


def test_discount(spark):
    df = spark.createDataFrame([(0.1,), (None,)], "discount double")
    assert rows(clean.default_discount(df)) == [(0.0,), (0.1,)]
    assert rows(clean.default_discount(spark.createDataFrame([(1,)], "k int"))) == [(1, 0.0)]


def test_day_from_any_type(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 2), datetime(2024, 1, 2, 3), "2024-1-2")], "a date, b timestamp, c string"
    )
    for name in "abc":
        df = clean.normalise_day(df, name)
    assert rows(df) == [(date(2024, 1, 2),) * 3]
    with pytest.raises(SchemaError):
        clean.normalise_day(df, "d")


def test_regions(spark):
    stores = spark.createDataFrame([("1",), ("2",)], "store_id string")
    own = spark.createDataFrame([("1", "West"), ("2", None)], "store_id string, region string")
    assert rows(clean.region_lookup(own)) == [("1", "West"), ("2", "Unknown")]
    assert rows(clean.region_lookup(stores, {"1": "South"})) == [("1", "South"), ("2", "Unknown")]
    assert rows(clean.region_lookup(stores)) == [("1", "1"), ("2", "2")]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 12, 30),), (date(2023, 1, 1),)], "d date")
    got = {r["date_key"]: r for r in df.select(*dates.calendar_columns("d")).collect()}
    assert (got[20241230]["week_of_year"], got[20241230]["day_of_week"]) == (1, 1)
    assert (got[20230101]["week_of_year"], got[20230101]["day_of_week"]) == (52, 7)
    assert got[20230101]["day_name"] == "Sunday" and got[20241230]["quarter"] == 4


def test_intervals(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 31), datetime(2024, 3, 1, 12), 2), (date(2023, 12, 30), datetime(2024, 2, 29), -1), (None, None, 1)],
        "d date, t timestamp_ntz, n int",
    )
    found = df.select(
        dates.shifted("d", months=1).alias("a"),
        dates.shifted("d", days=F.col("n"), months=F.col("n")).alias("b"),
        dates.shifted("t", hours=-13).alias("c"),
        dates.shifted("t", days=1, months=12).alias("e"),
        dates.whole_days("d", F.col("t").cast("date")).alias("f"),
    ).collect()
    # A day that the month does not have becomes its last one.
    assert tuple(found[0]) == (date(2024, 2, 29), date(2024, 4, 2), datetime(2024, 2, 29, 23), datetime(2025, 3, 2, 12), 30)
    assert tuple(found[1]) == (date(2024, 1, 30), date(2023, 11, 29), datetime(2024, 2, 28, 11), datetime(2025, 3, 1), 61)
    assert tuple(found[2]) == (None,) * 5
