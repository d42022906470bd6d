"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.catalogue import fragments as s
from tillwright.catalogue.base import query
from tillwright.operators import joins, key_filter, sets, windows
from tillwright.operators.clean import join_inputs
from tillwright.plans.optimised_join import wide_orders
from tillwright.schemas import TRACKED_CUSTOMER_COLUMNS
from tillwright.sources import bridge

WIDE_SQL = f"""WITH {s.CUSTOMERS}, {s.PRODUCTS}, {s.ORDERS}
    SELECT order_id, order_date, customer_id, customer_name, city, state, customer_segment,
           product_id, product_name, category, quantity, unit_price, price AS product_price,
           order_status, quantity * unit_price AS sales_amount
    FROM r_orders JOIN r_customers USING (customer_id) JOIN r_products USING (product_id)"""


def _inputs(t):
    return bridge.order_lines(t), bridge.customers(t, signup=False), bridge.products(t)


@query("jn_chain_star", WIDE_SQL)
def chain(t):
    return joins.star_chain(*join_inputs(*_inputs(t)))


@query(
    "jn_broadcast_capped",
    WIDE_SQL,
)
def capped(t):
    """Products are broadcast when their files are within the cap."""
    return wide_orders(*_inputs(t), broadcast_mb=100)


@query(
    "jn_left_on_right_on",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_name AS product_name
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10""",
)
def left_on(t):
    large = t.part.filter("p_size > 10").select("p_partkey", F.col("p_name").alias("product_name"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.lookup_on(lines, large, "l_partkey", "p_partkey")


ASOF_SQL = f"""WITH {s.HISTORY}, {s.ORDERS}
    SELECT order_id, product_id, o.customer_id, order_date, h.customer_key, h.customer_segment
    FROM r_orders o JOIN history h ON o.customer_id = h.customer_id
      AND order_date BETWEEN effective_from AND effective_to"""
ASOF = ("customer_id", "order_date", ["customer_key", "customer_segment"])


@query("jn_scd2_asof", ASOF_SQL)
def asof(t):
    orders = bridge.order_lines(t).select("order_id", "product_id", "customer_id", "order_date")
    return joins.as_of_version(orders, bridge.customer_history(t), *ASOF)


@query("jn_scd2_asof_merge", ASOF_SQL)
def asof_merge(t):
    """The same by one sorted stream of versions and orders."""
    orders = bridge.order_lines(t).select("order_id", "product_id", "customer_id", "order_date")
    return joins.as_of_merge(orders, bridge.customer_history(t), *ASOF)


@query(
    "jn_anti_delete",
    f"""WITH {s.RAW_ORDERS} SELECT order_id, product_id, store_id FROM raw_o WHERE order_id NOT IN
      (SELECT order_id FROM raw_o WHERE upper(trim(operation)) IN ('DELETE', 'D'))""",
)
def anti_delete(t):
    orders = bridge.raw_orders(t).select("order_id", "product_id", "store_id", "operation")
    gone = orders.filter(F.upper(F.trim("operation")).isin("DELETE", "D")).select("order_id")
    return joins.without_keys(orders.drop("operation"), gone, ["order_id"])


@query(
    "jn_semi_keys",
    """WITH i AS (SELECT DISTINCT user_id FROM events),
    e AS (SELECT DISTINCT o_custkey AS user_id FROM orders)
    SELECT count(*) FILTER (user_id NOT IN (SELECT user_id FROM e)) AS inserted,
           count(*) FILTER (user_id IN (SELECT user_id FROM e)) AS matched FROM i""",
)
def semi_keys(t):
    """Users of events against customers with orders."""
    return joins.key_overlap(
        t.events, t.orders.select(F.col("o_custkey").alias("user_id")), "user_id"
    )


@query(
    "jn_semi_filtered",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)""",
)
def semi_filtered(t):
    """Lines of few products: a bitmap of their keys drops most others before the join."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    few = t.part.filter("p_size > 45").select(F.col("p_partkey").cast("string").alias("l_partkey"))
    return key_filter.semi_join(lines, few, "l_partkey")


@query(
    "jn_enrich_wide",
    f"""WITH {s.CUSTOMERS}, {s.PRODUCTS}, {s.ORDERS}
    SELECT o.*, customer_name, email, customer_segment, city, state, product_name, category,
           supplier, price, {s.round2('quantity * unit_price')} AS total_amount
    FROM r_orders o LEFT JOIN (SELECT * FROM r_customers WHERE balance >= 0) USING (customer_id)
    LEFT JOIN r_products USING (product_id)""",
)
def enrich(t):
    orders, people, goods = _inputs(t)
    return joins.enrich_orders(orders, people.filter("balance >= 0"), goods)


@query(
    "jn_snapshot_diff",
    f"""WITH {s.CUSTOMERS} SELECT customer_id,
           CASE WHEN balance < 0 THEN 'new' WHEN balance > 9000 THEN 'changed'
                ELSE 'unchanged' END AS change,
           CASE WHEN balance > 9000 THEN 'PREMIUM' ELSE customer_segment END AS customer_segment,
           CASE WHEN balance >= 0 THEN customer_segment END AS old_customer_segment
    FROM r_customers""",
)
def diff(t):
    found = joins.snapshot_diff(
        bridge.snapshot(t, 2), bridge.snapshot(t, 1), "customer_id", TRACKED_CUSTOMER_COLUMNS
    )
    return found.select("customer_id", "change", "customer_segment", "old_customer_segment")


# --- set operations ---------------------------------------------------------------------


@query(
    "st_union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
    FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def union_by_name(t):
    people = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    shops = t.supplier.select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
    )
    return sets.union_by_name(people, shops)


@query(
    "st_union_relaxed",
    """SELECT CAST(p_partkey AS BIGINT) AS id, CAST(p_size AS DOUBLE) AS amount,
              CAST(p_size AS VARCHAR) AS code FROM part
    UNION ALL SELECT s_nationkey, s_acctbal, s_name FROM supplier""",
)
def union_relaxed(t):
    """Long with int, int with double, int with text."""
    goods = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("amount"), F.col("p_size").alias("code")
    )
    shops = t.supplier.select(
        F.col("s_nationkey").alias("id"),
        F.col("s_acctbal").alias("amount"),
        F.col("s_name").alias("code"),
    )
    return sets.union_relaxed(goods, shops)


@query(
    "st_dedup_key",
    """SELECT l_orderkey, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_orderkey""",
)
def dedup_key(t):
    lines = t.lineitem.select("l_orderkey", "l_shipdate")
    return windows.keep_last(lines, ["l_orderkey"], ["l_shipdate"])


@query("st_dedup_row", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_tax FROM lineitem")
def dedup_row(t):
    return sets.distinct_rows(
        t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", "l_tax")
    )


@query(
    "st_distinct_values",
    f"""WITH {s.CAST_ORDERS} SELECT DISTINCT order_date, store_id FROM cast_o
    WHERE order_date IS NOT NULL AND store_id IS NOT NULL""",
)
def distinct_values(t):
    from tillwright.operators.clean import cast_orders

    return sets.distinct_values(cast_orders(bridge.raw_orders(t)), "order_date", "store_id")


@query(
    "st_key_diff",
    """WITH l AS (SELECT DISTINCT user_id AS k FROM events),
    r AS (SELECT DISTINCT o_custkey AS k FROM orders)
    SELECT k, CASE WHEN l.k IS NOT NULL AND r.k IS NOT NULL THEN 'both'
                   WHEN l.k IS NOT NULL THEN 'left' ELSE 'right' END AS found_in
    FROM l FULL JOIN r USING (k)""",
)
def key_diff(t):
    return sets.key_sets(
        t.events.select(F.col("user_id").alias("k")),
        t.orders.select(F.col("o_custkey").alias("k")),
        "k",
    )
