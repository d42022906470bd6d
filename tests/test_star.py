from datetime import date

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillwright.operators import joins, windows
from tillwright.operators.quality import QualityError, verify_history
from tillwright.plans import analytics, marts, scd2, star
from tillwright.sources.tables import Warehouse

SOURCE = "customer_id string, customer_name string, email string, city string, state string, signup_date date, customer_segment string"
FIRST = "2024-01-01"
END = date(9999, 12, 31)


def source(spark, *records):
    """(id, city, segment)"""
    return spark.createDataFrame(
        [(i, f"n{i}", "e", c, "s", date(2023, 1, 1), s) for i, c, s in records], SOURCE
    )


def versions(dim):
    return rows(
        dim, "customer_key", "customer_id", "city", "effective_from", "effective_to", "is_current",
        "version",
    )


def test_first_load(spark):
    dim = scd2.build_customer_dimension(
        source(spark, ("b", "x", "s"), ("a", "y", "s"), (None, "z", "s")), None, FIRST, "2024-03-01"
    )
    assert versions(dim) == [
        (1, "a", "y", date(2024, 1, 1), END, True, 1),
        (2, "b", "x", date(2024, 1, 1), END, True, 1),
    ]


@pytest.fixture
def loaded(spark, folder):
    """A dimension after one load: a, b and c."""
    dim = scd2.build_customer_dimension(
        source(spark, ("a", "x", "s"), ("b", None, "s"), ("c", "x", "s")), None, FIRST, "2024-02-01"
    )
    dim.write.parquet(folder)
    return spark.read.parquet(folder)


def test_new_changed_unchanged_and_gone(spark, loaded):
    """a changes, b goes from null to a value, c is no longer in the source, d is new."""
    after = scd2.build_customer_dimension(
        source(spark, ("a", None, "s"), ("b", "y", "s"), ("d", "x", "s")), loaded, FIRST, "2024-03-01"
    )
    run, day_before = date(2024, 3, 1), date(2024, 2, 29)
    first = date(2024, 1, 1)
    assert versions(after) == [
        (1, "a", "x", first, day_before, False, 1),
        (2, "b", None, first, day_before, False, 1),
        (3, "c", "x", first, END, True, 1),
        (4, "a", None, run, END, True, 2),
        (5, "b", "y", run, END, True, 2),
        (6, "d", "x", run, END, True, 1),
    ]
    assert rows(verify_history(after)) == [(6, 4, 2, 0, 0)]


def test_same_source_changes_nothing(spark, loaded):
    same = source(spark, ("a", "x", "s"), ("b", None, "s"), ("c", "x", "s"))
    after = scd2.build_customer_dimension(same, loaded, FIRST, "2024-03-01")
    assert versions(after) == versions(loaded)


def test_second_run_on_one_day_updates_in_place(spark, loaded, folder):
    one = scd2.build_customer_dimension(source(spark, ("a", "y", "s")), loaded, FIRST, "2024-03-01")
    one.write.parquet(folder + "-one")
    two = scd2.build_customer_dimension(
        source(spark, ("a", "z", "s")), spark.read.parquet(folder + "-one"), FIRST, "2024-03-01"
    )
    assert [v for v in versions(two) if v[1] == "a"] == [
        (1, "a", "x", date(2024, 1, 1), date(2024, 2, 29), False, 1),
        (4, "a", "z", date(2024, 3, 1), END, True, 2),
    ]


def test_rebuild_rules(spark, loaded):
    from pyspark.sql import functions as F

    assert scd2.must_rebuild(loaded.drop("version"), FIRST)
    assert scd2.must_rebuild(loaded, "2023-12-31")
    assert not scd2.must_rebuild(loaded, FIRST)
    with pytest.raises(ValueError, match="no current row"):
        scd2.must_rebuild(loaded.withColumn("is_current", F.lit(False)), FIRST)


ORDERS = "order_id string, customer_id string, product_id string, store_id string, order_date date, quantity bigint, unit_price double"


def orders(spark, *records):
    return spark.createDataFrame(records, ORDERS)


def dims(spark, placed):
    products = spark.createDataFrame(
        [("p1", "n1", "c1", 1.0, "s"), ("p2", "n2", None, 1.0, "s")],
        "product_id string, product_name string, category string, price double, supplier string",
    )
    return (
        star.product_dimension(products),
        star.store_dimension(placed),
        star.date_dimension(placed),
    )


def history(spark):
    return spark.createDataFrame(
        [
            (1, "a", date(2024, 1, 10), date(2024, 1, 31), False, 1),
            (2, "a", date(2024, 2, 1), END, True, 2),
        ],
        "customer_key bigint, customer_id string, effective_from date, effective_to date, "
        "is_current boolean, version int",
    )


def test_fact_takes_the_version_of_the_order_day(spark):
    placed = orders(
        spark,
        ("o0", "a", "p1", "1", date(2024, 1, 9), 1, 1.0),
        ("o1", "a", "p1", "1", date(2024, 1, 10), 2, 1.5),
        ("o2", "a", "p1", "1", date(2024, 1, 31), 1, 1.0),
        ("o3", "a", "p2", "2", date(2024, 2, 1), 1, 1.0),
        ("o4", "b", "p1", "1", date(2024, 2, 1), 1, 1.0),
        ("o1", "a", "p1", "1", date(2024, 1, 10), 1, 1.5),
    )
    fact = star.build_fact(placed, history(spark), *dims(spark, placed))
    assert rows(fact, "sale_id", "customer_key", "product_key", "store_key", "sales_amount") == [
        ("o1", 1, 1, 1, 3.0), ("o2", 1, 1, 1, 1.0), ("o3", 2, 2, 2, 1.0),
    ]
    assert {r["discount"] for r in fact.collect()} == {0.0}


def test_unknown_product_fails_the_fact(spark):
    placed = orders(spark, ("o1", "a", "p9", "1", date(2024, 1, 10), 2, 1.5))
    fact = star.build_fact(placed, history(spark), *dims(spark, placed))
    with pytest.raises(Exception, match="no product_key"):
        fact.collect()


def test_overlapping_versions_do_not_double_sales(spark):
    from pyspark.sql import functions as F

    placed = orders(spark, ("o1", "a", "p1", "1", date(2024, 2, 10), 2, 1.5))
    broken = history(spark).withColumn("effective_to", F.lit(END))
    assert star.versions_overlap(broken) and not star.versions_overlap(history(spark))
    assert star.build_fact(placed, broken, *dims(spark, placed)).count() == 1


def test_whole_star_and_marts(spark, folder):
    warehouse = Warehouse(spark, folder)
    placed = orders(
        spark,
        ("o1", "a", "p1", "1", date(2024, 1, 10), 2, 1.5),
        ("o2", "b", "p2", "2", date(2024, 2, 10), 0, 5.0),
    )
    people = source(spark, ("a", "x", "s"), ("b", "y", None))
    goods = spark.createDataFrame(
        [("p1", "n1", "c1", 1.0, "s"), ("p2", "n2", None, 1.0, "s")],
        "product_id string, product_name string, category string, price double, supplier string",
    )
    counts = star.load_star(warehouse, people, goods, placed, "2024-03-01")
    assert counts == {"dim_customer": 2, "dim_product": 2, "dim_store": 2, "dim_date": 2, "fact_sales": 2}
    marts.load_marts(warehouse, {"1": "West"})
    assert rows(warehouse.read("mart_sales_summary"), "region", "category", "total_revenue") == [
        ("Unknown", "Unknown", 0.0), ("West", "c1", 3.0),
    ]
    assert rows(warehouse.read("mart_customer_analytics"), "customer_id", "customer_segment") == [
        ("a", "s"), ("b", "Unknown"),
    ]
    # No quantity, no average price.
    assert rows(warehouse.read("mart_product_analytics"), "product_id", "average_price", "sales_rank") == [
        ("p1", 1.5, 1), ("p2", 0.0, 2),
    ]


def test_marts_need_the_star(spark, folder):
    with pytest.raises(LookupError):
        marts.load_marts(Warehouse(spark, folder))


def test_orders_without_dates_stop_the_star(spark, folder):
    placed = orders(spark, ("o1", "a", "p1", "1", None, 2, 1.5))
    with pytest.raises(ValueError, match="no date"):
        star.load_star(Warehouse(spark, folder), source(spark, ("a", "x", "s")), placed, placed, FIRST)


# --- questions ----------------------------------------------------------------------


def small_star(spark):
    fact = spark.createDataFrame(
        [
            ("s1", 11, 1, 20240115, 2, 100.0),
            ("s2", 11, 1, 20240315, 1, 50.0),
            ("s3", 12, 2, 20240320, 1, 80.0),
            ("s4", 21, 2, 20240520, 3, 60.0),
        ],
        "sale_id string, customer_key bigint, product_key bigint, date_key int, quantity bigint, "
        "sales_amount double",
    )
    day = spark.createDataFrame(
        [(20240115, date(2024, 1, 15)), (20240315, date(2024, 3, 15)),
         (20240320, date(2024, 3, 20)), (20240520, date(2024, 5, 20))],
        "date_key int, full_date date",
    )
    product = spark.createDataFrame(
        [(1, "p1", "n1", "A"), (2, "p2", "n2", "B")],
        "product_key bigint, product_id string, product_name string, category string",
    )
    customer = spark.createDataFrame(
        [
            (11, "c1", "Pune", False), (13, "c1", "Pune", True), (12, "c2", "Goa", True),
            (21, "c3", "Goa", True), (31, "c4", "Goa", True),
        ],
        "customer_key bigint, customer_id string, city string, is_current boolean",
    ).selectExpr(
        "*", "'n' AS customer_name", "'e' AS email", "'s' AS state", "'g' AS customer_segment",
        "DATE '2024-01-01' AS effective_from",
    )
    return fact, day, product, customer


def test_growth_skips_absent_months(spark):
    fact, day, _, _ = small_star(spark)
    assert rows(analytics.monthly_revenue(fact, day)) == [
        (date(2024, 1, 1), 100.0, 1, None, None),
        (date(2024, 3, 1), 130.0, 2, 100.0, 30.0),
        (date(2024, 5, 1), 60.0, 1, 130.0, (60.0 - 130.0) / 130.0 * 100.0),
    ]


def test_inactive_by_version_and_by_customer(spark):
    """c1's only recent order hangs on its closed version."""
    fact, day, _, customer = small_star(spark)
    by_key = analytics.inactive_customers(fact, day, customer)
    assert rows(by_key, "customer_id") == [("c1",), ("c4",)]
    by_id = analytics.inactive_customers(fact, day, customer, by="customer_id")
    assert rows(by_id, "customer_id") == [("c4",)]


def test_declining_counts_absent_latest_month_as_zero(spark):
    fact, day, product, _ = small_star(spark)
    found = analytics.declining_categories(fact, product, day)
    assert rows(found) == [
        ("A", 50.0, 0.0, -50.0, -100.0), ("B", 80.0, 60.0, -20.0, -25.0),
    ]


def test_declining_needs_two_months(spark):
    fact, day, product, _ = small_star(spark)
    one = analytics.declining_categories(fact.filter("sale_id = 's1'"), product, day)
    assert one.isEmpty()


# --- numbering ------------------------------------------------------------------------


def test_numbers_follow_the_order_without_gaps(spark):
    df = spark.range(5000).selectExpr("CAST(id * 7919 % 5003 AS STRING) AS k").repartition(13)
    got = windows.number_rows(df, ["k"], "n", 10)
    listed = [r["k"] for r in got.orderBy("n").collect()]
    assert listed == sorted(listed)
    assert [r["n"] for r in got.orderBy("n").collect()] == list(range(10, 5010))


def test_numbering_nothing(spark):
    assert windows.number_rows(spark.range(0), ["id"], "n").count() == 0


def test_dense_rank_with_hot_value(spark):
    df = spark.range(900).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 50 END AS v")
    got = windows.dense_rank_by(df, "v", "r")
    order = {v: i + 1 for i, v in enumerate(sorted({r["v"] for r in df.collect()}, reverse=True))}
    assert all(r["r"] == order[r["v"]] for r in got.collect()) and got.count() == 900


def test_a_damaged_star_stops_the_load(spark):
    fact = spark.createDataFrame(
        [("1", 1, 1, 1, 1, 2, 5.0, 0.0)],
        "sale_id string, customer_key bigint, product_key bigint, store_key bigint, date_key int, "
        "quantity bigint, sales_amount double, discount double",
    )
    dim = spark.createDataFrame(
        [("1", date(2024, 1, 1), date(9999, 12, 31), True)],
        "customer_id string, effective_from date, effective_to date, is_current boolean",
    )
    assert star.require_sound_star(fact, dim)["fact_total_rows"] == 1
    with pytest.raises(QualityError, match="duplicate_sale_ids"):
        star.require_sound_star(fact.union(fact), dim)
    with pytest.raises(QualityError, match="bad_current_keys"):
        star.require_sound_star(fact, dim.union(dim))
    reversed_days = dim.withColumn("effective_to", F.lit("2023-01-01").cast("date"))
    with pytest.raises(QualityError, match="bad_date_order"):
        star.require_sound_star(fact, reversed_days)


def test_a_damaged_star_leaves_the_old_one(spark, folder, monkeypatch):
    warehouse = Warehouse(spark, folder)
    customers = spark.createDataFrame(
        [("1", "A", "a@x.de", "C", "S", date(2024, 1, 1), "SEG")],
        "customer_id string, customer_name string, email string, city string, state string, "
        "signup_date date, customer_segment string",
    )
    products = spark.createDataFrame(
        [("1", "P", "CAT", 2.0, "SUP")],
        "product_id string, product_name string, category string, price double, supplier string",
    )
    kind = "order_id string, customer_id string, product_id string, store_id string, order_date date, quantity bigint, unit_price double"
    orders = spark.createDataFrame([("1", "1", "1", "1", date(2024, 1, 2), 1, 2.0)], kind)
    star.load_star(warehouse, customers, products, orders, "2024-02-01")
    names = ["dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales"]
    before = {n: rows(warehouse.read(n)) for n in names}
    more = orders.union(spark.createDataFrame([("2", "1", "1", "2", date(2024, 1, 3), 1, 2.0)], kind))
    build = star.build_fact
    monkeypatch.setattr(star, "build_fact", lambda *args: build(*args).union(build(*args)))
    with pytest.raises(QualityError, match="duplicate_sale_ids"):
        star.load_star(warehouse, customers, products, more, "2024-02-02")
    assert {n: rows(warehouse.read(n)) for n in names} == before
    monkeypatch.setattr(star, "build_fact", build)
    star.load_star(warehouse, customers, products, more, "2024-02-02")
    assert warehouse.read("fact_sales").count() == 2 and warehouse.read("dim_store").count() == 2


def versioned(spark, records):
    return spark.createDataFrame(
        records, "customer_key bigint, customer_id string, effective_from date, effective_to date"
    )


def test_as_of_merge_equals_the_join(spark):
    from datetime import timedelta

    day = date(2024, 1, 1)
    # A key with 1,500 versions of a day, gaps among them; an open one; one that begins late.
    versions = [(i, "many", day + timedelta(i), day + timedelta(i)) for i in range(1500) if i % 10]
    versions += [(5000, "open", day, END), (5001, "late", day + timedelta(400), END), (5002, None, day, END)]
    dim = versioned(spark, versions)
    facts = [(f"m{i}", "many", day + timedelta(i), 1) for i in range(0, 1600, 3)]
    # A hot key, days before, at and after every edge, nulls.
    facts += [(f"o{i}", "open", day + timedelta(i % 700 - 5), 2) for i in range(900)]
    facts += [("l1", "late", day + timedelta(399), 3), ("l2", "late", day + timedelta(400), 3)]
    facts += [("n1", None, day, 4), ("n2", "open", None, 5), ("u", "unknown", day, 6)]
    sales = spark.createDataFrame(facts, "sale string, customer_id string, d date, effective_to int")
    args = ("customer_id", "d", ["customer_key"])
    merged = joins.as_of_merge(sales, dim, *args)
    assert merged.columns == [*sales.columns, "customer_key"]
    assert rows(merged) == rows(joins.as_of_version(sales, dim, *args))
    assert rows(joins.as_of(sales, dim, *args)) == rows(merged)
    # Where no key is hot nothing is cut into months.
    few = sales.where("customer_id = 'many'").limit(3).unionByName(sales.where("customer_id <> 'many'").limit(2))
    assert rows(joins.as_of_merge(few, dim, *args)) == rows(joins.as_of_version(few, dim, *args))
    assert joins.as_of_merge(sales.limit(0), dim, *args).count() == 0
    assert joins.as_of_merge(sales, dim.limit(0), *args).count() == 0


def test_one_join_in_the_dimension(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(scd2, "cut", lambda df: seen.append(plan(df)) or df.checkpoint())
    source_1 = source(spark, ("1", "a", "x"), ("2", "b", "x"), ("3", "c", "x"))
    dim = scd2.build_customer_dimension(source_1, None, FIRST, "2024-02-01")
    source_2 = source(spark, ("1", "a", "x"), ("2", "moved", "x"), ("4", None, "x"))
    second = scd2.build_customer_dimension(source_2, dim, FIRST, "2024-02-02")
    assert len(seen) == 1 and seen[0].count("FullOuter") == 1
    found = rows(second, "customer_key", "customer_id", "city", "is_current", "version")
    assert found == [
        (1, "1", "a", True, 1), (2, "2", "b", False, 1), (3, "3", "c", True, 1),
        (4, "2", "moved", True, 2), (5, "4", None, True, 1),
    ]
