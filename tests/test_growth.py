"""Shuffles that a job can do without: their number, and the results without them."""

from datetime import date, datetime

import pytest
from helpers import plan, rows

from tillwright.catalogue import jobs
from tillwright.operators import joins, upsert
from tillwright.plans import curate, marts, star, state
from tillwright.sources import bridge
from tillwright.sources.bridge import Tables
from tillwright.sources.tables import Warehouse

OLD = [("1", 10, "a"), ("2", 20, None), ("3", 30, "c"), ("5", 50, "e")]
NEW = [(" 2", 21, "new"), ("4", 41, None), (None, 0, "no key")]
KIND = "k string, v bigint, note string"


def test_replaced_keys_are_the_upsert_s(spark):
    old, new = spark.createDataFrame(OLD, KIND), spark.createDataFrame(NEW, KIND).drop("note")
    deletes = spark.createDataFrame([(3,), (9,), (None,)], "k bigint")
    for state_before in (old, None):
        for gone in (deletes, None):
            before = upsert.apply_deletes(state_before, gone, "k") if gone is not None else state_before
            expected = upsert.upsert(before, new, "k")
            found = upsert.replace_keys(state_before, new, gone, "k")
            assert found.columns == expected.columns
            assert rows(found) == rows(expected)


def test_rows_that_are_unique_are_not_ordered_again(spark, folder, monkeypatch):
    zones = Warehouse(spark, folder)

    def no_order(*args):
        raise AssertionError("unique rows were put in order by key")

    monkeypatch.setattr(state, "upsert", no_order)
    for batch in (OLD, NEW):
        state.apply_changes(zones, "t", "k", spark.createDataFrame(batch, KIND), unique=True)
    assert rows(zones.read("t")) == sorted(
        [("1", 10, "a"), ("2", 21, "new"), ("3", 30, "c"), ("4", 41, None), ("5", 50, "e")], key=repr
    )


RAW = (
    "order_id string, customer_id string, product_id string, order_date string, quantity string, "
    "unit_price string, payment_method string, order_status string, store_id string, at string"
)
LINES = [
    ("1", "7", "8", "2024-01-05", "2", "1.5", "card", "new", "1", "2024-01-05"),
    ("1", "7", "8", "2024-01-05", "3", "1.5", "card", "new", "1", "2024-01-05"),
    ("2", "7", "8", "2024-02-05", "1", "9.999", "card", "new", "1", "2024-01-06"),
    ("2", "7", "8", "2024-02-05", "4", "0.125", "card", "new", "2", "2024-01-05"),
]


@pytest.mark.parametrize("arrival", [["at"], None, ["order_amount"]])
def test_amounts_are_computed_for_the_rows_that_stay(spark, arrival):
    raw = spark.createDataFrame(LINES, RAW)
    known = spark.createDataFrame([(7, 8)], "customer_id bigint, product_id bigint")
    valid = curate.curate_orders(raw, known, known, arrival).valid
    second = (1, 9.999, 10.0) if arrival in (["at"], ["order_amount"]) else (4, 0.5, 0.5)
    assert rows(valid, "order_id", "quantity", "total_amount", "order_amount") == [
        (1, 3, 4.5, 4.5), (2, *second),
    ]
    if arrival != ["order_amount"]:
        shuffle = next(line for line in plan(curate.curate_enriched(raw, arrival).valid).splitlines() if "Exchange" in line)
        assert "total_amount" not in shuffle
        assert plan(valid).index("total_amount") < plan(valid).index("Window")


def test_one_pass_for_stores_and_days(spark, data):
    lines = spark.createDataFrame(
        [(" 1", "2024-01-05"), ("1", "2024-1-5"), (None, "2024-01-06"), ("2", None)],
        "store_id string, order_date string",
    )
    stores, days = star.order_dimensions(lines)
    assert rows(stores) == rows(star.store_dimension(lines)) == [(1, "1"), (2, "2")]
    assert rows(days) == rows(star.date_dimension(lines))
    assert days.count() == 2


def test_a_mart_builds_its_own_star(spark, data):
    (first, _), (second, _) = (jobs._stored_star(Tables(spark, data)) for _ in range(2))
    assert set(first.inputFiles()).isdisjoint(second.inputFiles())
    assert first.count() == second.count()


LINE = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp"
HEAD = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string, o_orderstatus string"
DAY = datetime(2024, 1, 5)


def given(spark, *numbers):
    """Tables whose lines have these (order key, line number, quantity)."""
    t = Tables(spark, "unused")
    lines = [(k, n, 3, 4, q, 10.0, 0.5, DAY) for k, n, q in numbers]
    heads = [(k, 7, DAY, "1-URGENT", "O") for k in sorted({k for k, *_ in numbers})]
    t._read = {"lineitem": spark.createDataFrame(lines, LINE), "orders": spark.createDataFrame(heads, HEAD)}
    return t


def built(spark, t):
    orders, within = jobs._keyed_orders(t)
    people = spark.createDataFrame(
        [("7", 70, date(2020, 1, 1), date(9999, 12, 31), True)],
        "customer_id string, customer_key bigint, effective_from date, effective_to date, is_current boolean",
    )
    goods = spark.createDataFrame([(30, "3")], "product_key bigint, product_id string")
    dims = star.order_dimensions(orders)
    return star.build_fact(orders, people, goods, *dims, ["arrived_on"], within), within


def test_orders_are_not_dealt_out_again_by_number(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, within = built(spark, given(spark, (1, 1, 2.0), (1, 1, 5.0), (1, 2, 1.0), (2, 1, 4.0)))
        assert within == bridge.ORDER_KEY
        dealt = [x for x in plan(fact).splitlines() if "Exchange hashpartitioning(order_id" in x]
        assert not dealt
        assert rows(fact, "sale_id", "quantity", "sales_amount") == [
            ("11", 5, 10.0), ("12", 1, 10.0), ("21", 4, 10.0),
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("line", [15, -5, None])
def test_numbers_that_two_keys_share_are_one_order(spark, line):
    numbers = {15: [(1, 15, 2.0), (2, 5, 6.0)], -5: [(3, -5, 2.0), (2, 5, 6.0)], None: [(1, None, 2.0), (2, None, 6.0)]}
    fact, within = built(spark, given(spark, *numbers[line]))
    assert within is None
    assert rows(fact, "sale_id", "quantity") == [(None if line is None else "25", 6)]


FACT = "sale_id string, customer_key bigint, product_key bigint, store_key bigint, date_key int, quantity bigint, sales_amount double, discount double"
SALES = [
    ("1", 1, 1, 1, 20240101, 2, 10.005, 0.0),
    ("2", 2, 1, 1, 20240101, 1, 2.5, 0.0),
    ("3", 1, 2, 2, 20240102, 4, float("nan"), 0.0),
    (None, 1, 9, 9, 20240102, None, 1.0, 0.0),
    ("5", 3, 2, 1, 20240102, 1, None, 0.0),
]


@pytest.fixture
def sold(spark):
    frame = spark.createDataFrame
    days = frame([(20240101, date(2024, 1, 1)), (20240102, date(2024, 1, 2))], "date_key int, full_date date")
    people = frame(
        # b is listed twice, as where a source repeats a customer
        [(1, "a", "x", False), (2, "a", "y", True), (3, "b", "z", True), (3, "b", "z", True), (8, None, "n", True)],
        "customer_key bigint, customer_id string, customer_segment string, is_current boolean",
    )
    goods = frame([(1, "c"), (2, None)], "product_key bigint, category string")
    shops = frame([(1, "s1"), (2, "s2")], "store_key bigint, store_id string")
    regions = frame([("s1", "west"), ("s2", "east")], "store_id string, region string")
    return frame(SALES, FACT), days, people, goods, shops, regions


def test_unique_sales_are_counted_without_their_ids(spark, sold):
    fact, days, _, goods, shops, regions = sold
    summary, known = (marts.sales_summary(fact, days, goods, shops, regions, u) for u in (False, True))
    assert rows(known) == rows(summary)
    assert (date(2024, 1, 2), "Unknown", "Unknown", 0, None, 1.0) in rows(known)
    assert "distinct" not in plan(known)


def test_customers_are_summed_by_key_before_the_join(spark, sold):
    fact, days, people, *_ = sold
    by_customer, summed = (marts.customer_analytics(fact, days, people, u) for u in (False, True))
    assert rows(summed) == rows(by_customer)
    assert [r[:2] for r in rows(summed)] == [("a", 3), ("b", 1)]
    assert "distinct" not in plan(summed)


def test_a_copied_customer_adds_amounts_as_often(spark, sold):
    fact, days, people, *_ = sold
    more = fact.union(spark.createDataFrame([("6", 3, 1, 1, 20240101, 1, 4.0, 0.0)], FACT))
    by_customer, summed = (marts.customer_analytics(more, days, people, u) for u in (False, True))
    assert rows(summed) == rows(by_customer)
    assert [r[:3] for r in rows(summed) if r[0] == "b"] == [("b", 2, 8.0)]


def test_a_table_of_few_rows_is_sent_to_every_task(spark, monkeypatch):
    wide = spark.range(100).withColumnRenamed("id", "k").repartition(4)
    small = spark.range(5).withColumnRenamed("id", "k").repartition(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(wide.join(joins.few_rows(small), "k", "left"))
        monkeypatch.setattr(joins, "FEW_ROWS", 4)
        assert "BroadcastHashJoin" not in plan(wide.join(joins.few_rows(small), "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
