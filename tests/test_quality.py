import pytest
from helpers import plan, rows

from tillwright.operators import clean, quality
from tillwright.plans import curate
from tillwright.schemas import SchemaError

CUSTOMER = "customer_id string, customer_name string, email string, city string, state string, signup_date string, customer_segment string"


def customers(spark, *records):
    full = [(i, n, e, "Pune", "mh", "2024-01-05", s) for i, n, e, s in records]
    return spark.createDataFrame(full, CUSTOMER)


def test_customers(spark):
    raw = customers(
        spark,
        (" 1 ", "  ann LEE ", " Ann@X.com ", "smb"),
        ("2", "bob", "no-at", "smb"),
        ("3", "cy", None, "smb"),
        (None, "di", "d@x.org", "smb"),
        ("x", "ed", "e@x.org", "smb"),
    )
    checked = curate.curate_customers(raw)
    assert rows(checked.valid, "customer_id", "customer_name", "email", "state") == [
        (1, "ann LEE", "ann@x.com", "MH")
    ]
    assert checked.rejected.count() == 4
    assert {r["dq_reason"] for r in checked.rejected.collect()} == {quality.RULE_REASON}


def test_duplicate_customer_keeps_last_arrival(spark):
    raw = customers(spark, ("1", "a", "a@x.com", "zzz"), ("1", "a", "a@x.com", "aaa"))
    from pyspark.sql import functions as F

    ordered = raw.withColumn("arrival", F.when(F.col("customer_segment") == "aaa", 2).otherwise(1))
    checked = curate.curate_customers(ordered, arrival=["arrival"])
    assert rows(checked.valid, "customer_segment") == [("AAA",)]


def test_folder_copied_twice_changes_nothing(spark):
    raw = customers(spark, ("1", "a", "a@x.com", "smb"), ("2", "b", "b@x.com", "smb"))
    once, twice = curate.curate_customers(raw), curate.curate_customers(raw.union(raw))
    assert rows(once.valid) == rows(twice.valid)


def products(spark, *records):
    return spark.createDataFrame(
        records, "product_id string, product_name string, category string, price string, supplier string"
    )


def test_products(spark):
    raw = products(
        spark,
        ("1", "a", "x", "1.5", "s"),
        ("2", None, "x", "1", "s"),
        ("3", " ", "x", "1", "s"),
        ("4", "d", "x", "-1", "s"),
        ("5", "e", "x", "free", "s"),
        ("6", "f", "x", "0", "s"),
    )
    checked = curate.curate_products(raw)
    assert rows(checked.valid, "product_id") == [(1,), (6,)]
    reasons = {r["product_id"]: r["failed_rules"] for r in checked.rejected.collect()}
    assert reasons == {
        2: ["product_name_missing"],
        3: ["product_name_empty"],
        4: ["price_negative"],
        5: ["price_missing"],
    }


def test_all_products_invalid(spark):
    checked = curate.curate_products(products(spark, ("1", "", "x", "1", "s")))
    assert checked.valid.isEmpty() and checked.rejected.count() == 1


def orders(spark, *records):
    """(order, customer, product, date, quantity, price[, operation])"""
    full = [(*r[:6], "upi", "shipped", "7", r[6] if len(r) > 6 else "UPSERT") for r in records]
    return spark.createDataFrame(
        full,
        "order_id string, customer_id string, product_id string, order_date string, "
        "quantity string, unit_price string, payment_method string, order_status string, "
        "store_id string, operation string",
    )


@pytest.fixture
def known(spark):
    return (
        spark.createDataFrame([(1,), (2,)], "customer_id bigint"),
        spark.createDataFrame([("10",), ("11",)], "product_id string"),
    )


def test_orders(spark, known):
    raw = orders(
        spark,
        ("1", "1", "10", "2024-1-5", "2", "1.25"),
        ("2", "1", "10", "2024-01-05", "0", "1"),
        ("3", "1", "10", "2024-01-05", "-3", "1"),
        ("4", "1", "10", "2024-01-05", "two", "1"),
        ("5", "1", "10", "2024-13-05", "1", "1"),
        ("6", "9", "10", "2024-01-05", "1", "1"),
        ("7", "1", "99", "2024-01-05", "1", "1"),
        ("8", "9", "99", "2024-01-05", "0", "1"),
        ("9", "1", "10", "2024-01-05", "1", "1", " d "),
    )
    checked = curate.curate_orders(raw, *known)
    assert rows(checked.valid, "order_id", "total_amount", "order_amount", "order_year") == [
        (1, 2.5, 2.5, 2024)
    ]
    assert rows(checked.deletes) == [(9,)]
    got = {r["order_id"]: (r["dq_reason"], r["failed_rules"]) for r in checked.rejected.collect()}
    assert got == {
        2: (quality.RULE_REASON, ["quantity_not_positive"]),
        3: (quality.RULE_REASON, ["quantity_not_positive"]),
        4: (quality.RULE_REASON, ["quantity_missing"]),
        5: (quality.RULE_REASON, ["order_date_missing"]),
        6: (quality.REFERENCE_REASON, ["customer_id_unknown"]),
        7: (quality.REFERENCE_REASON, ["product_id_unknown"]),
        8: (quality.RULE_REASON, ["quantity_not_positive"]),
    }


def test_split_is_exhaustive_and_disjoint(spark, known):
    raw = orders(spark, *[(str(i), "1", "10", "2024-01-05", str(i % 3), "1") for i in range(30)])
    typed = clean.cast_orders(raw)
    valid, rejected = quality.split_valid(typed, quality.order_rules())
    assert valid.count() + rejected.count() == 30
    assert not set(rows(valid, "order_id")) & set(rows(rejected, "order_id"))


def test_references_ignore_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    table = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    valid, rejected = quality.check_references(df, {"k": table})
    assert rows(valid) == [(1, "a")]
    assert rows(rejected, "v") == [("b",), ("c",)]


def test_rule_suite(spark):
    df = spark.createDataFrame(
        [("1", "A", "5"), ("1", "B", None), (None, None, "x"), ("2", "A", "11")],
        "id string, kind string, n string",
    )
    report = quality.rule_suite(
        df,
        required_columns=["id", "gone"],
        unique_key="id",
        not_null_columns=["kind"],
        accepted_values={"kind": ["A"]},
        numeric_ranges={"n": (1, 10)},
    )
    assert rows(report) == sorted(
        [
            ("required", "id", 0, 4),
            ("required", "gone", 4, 4),
            ("unique", "id", 1, 4),
            ("not_null", "kind", 1, 4),
            ("accepted_values", "kind", 1, 4),
            ("numeric_range", "n", 2, 4),
        ],
        key=repr,
    )
    with pytest.raises(quality.QualityError):
        quality.rule_suite(df)


def test_inspect(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None)], "a int, b string")
    # Two blank rows, one repeat of each distinct row.
    assert rows(quality.inspect_rows(df)) == [(4, 2, 2, 4, 4, 0)]
    assert rows(quality.inspect_rows(df.limit(0))) == [(0, 0, 0, 0, 0, 0)]


def test_gate(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert quality.gate_lookups(df, ["a"]) is df
    with pytest.raises(quality.QualityError, match="'missing_b': 1"):
        quality.gate_lookups(df, ["a", "b"])


def test_fact_columns(spark):
    with pytest.raises(SchemaError):
        quality.verify_fact(spark.createDataFrame([(1,)], "sale_id int"))


def test_first_change_column_counts(spark):
    df = spark.createDataFrame(
        [("U", "DELETE"), ("d", "U"), (None, "DELETE")], "operation string, change_type string"
    )
    assert rows(quality.split_deletes(df)[1]) == [("d", "U")]
    plain = spark.createDataFrame([(1,)], "k int")
    assert quality.split_deletes(plain)[1].isEmpty()


def test_integrity_reads_the_orders_once(spark):
    orders = spark.createDataFrame(
        [("1", 1, "p", None), ("1", 1, "p", "n"), ("2", None, "q", "n"), (None, 3, "p", "n"), ("4", 9, None, "n")],
        "order_id string, customer_id int, product_id string, customer_name string",
    )
    people = spark.createDataFrame([(1,), (3,), (None,)], "customer_id bigint")
    goods = spark.createDataFrame([("p",), ("p",)], "product_id string")
    found = quality.integrity_report(orders, people, goods)
    assert dict(rows(found)) == {
        "missing_order_id": 1, "missing_customer_id": 1, "missing_product_id": 1, "missing_customer_name": 1,
        "duplicate_order_id": 1, "orphan_customer_id": 1, "orphan_product_id": 1,
    }
    nothing = dict(rows(quality.integrity_report(orders.limit(0), people, goods)))
    assert set(nothing.values()) == {0} and len(nothing) == 7


def test_rows_without_a_key_are_spread(spark):
    orders = spark.createDataFrame([(None, i) for i in range(500)] + [(7, 1), (8, 2)], "customer_id bigint, n int")
    people = spark.createDataFrame([(7,), (None,)], "customer_id bigint")
    valid, rejected = quality.check_references(orders, {"customer_id": people.hint("merge")})
    assert rows(valid) == [(7, 1)] and rejected.count() == 501
    joined = quality.classify(orders, {}, {"customer_id": people.hint("merge")})
    assert "hashpartitioning(customer_id" in plan(joined) and "__null_spread" in plan(joined)
