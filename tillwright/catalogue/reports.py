"""Business questions and their building blocks on the star views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.catalogue import fragments as s
from tillwright.catalogue.base import query
from tillwright.functions.dates import month_start
from tillwright.operators import aggregates, joins, ordering, windows
from tillwright.operators.clean import month_column
from tillwright.plans import adhoc, analytics
from tillwright.session import run_dir
from tillwright.sources import bridge
from tillwright.sources.storage import read_table

STAR = f"{s.FACT}, {s.DIM_DATE}, {s.DIM_PRODUCT}"


@query(
    "q1_top_products",
    f"""WITH {s.FACT}, {s.DIM_PRODUCT}
    SELECT product_id, product_name, category, {s.money('sales_amount')} AS revenue,
           CAST(sum(quantity) AS BIGINT) AS units_sold
    FROM fact JOIN d_product USING (product_key)
    GROUP BY product_id, product_name, category ORDER BY revenue DESC, product_id LIMIT 10""",
)
def q1(t):
    return analytics.top_products(bridge.fact_sales(t, with_order=False), bridge.dim_product(t))


@query(
    "q2_city_sales",
    f"""WITH {s.FACT} SELECT n_name AS city, {s.money('sales_amount')} AS total_sales,
           count(DISTINCT sale_id) AS orders
    FROM fact JOIN customer ON customer_key = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY total_sales DESC, city""",
)
def q2(t):
    people = bridge.customers(t, signup=False).withColumn(
        "customer_key", F.col("customer_id").cast("bigint")
    )
    return analytics.city_sales(bridge.fact_sales(t), people)


@query(
    "q3_mom_revenue",
    f"""WITH {s.FACT}, {s.DIM_DATE}, m AS (
      SELECT CAST(date_trunc('month', full_date) AS DATE) AS month,
             {s.money('sales_amount')} AS revenue, count(DISTINCT sale_id) AS orders
      FROM fact JOIN d_date USING (date_key) GROUP BY 1),
    l AS (SELECT *, lag(revenue) OVER (ORDER BY month) AS previous_month_revenue FROM m)
    SELECT month, revenue, orders, previous_month_revenue,
           CASE WHEN previous_month_revenue <> 0
                THEN (revenue - previous_month_revenue) / previous_month_revenue * 100.0 END
             AS mom_growth_percent
    FROM l ORDER BY month""",
)
def q3(t):
    return analytics.monthly_revenue(bridge.fact_sales(t), bridge.dim_date(t))


Q4_SQL = f"""WITH {s.FACT}, {s.DIM_DATE}, {s.DIM_CUSTOMER}
    SELECT customer_key, customer_id, customer_name, email, city, state, customer_segment,
           effective_from
    FROM d_customer WHERE is_current AND customer_key NOT IN (
      SELECT customer_key FROM fact JOIN d_date USING (date_key)
      WHERE full_date >= (SELECT max(full_date) FROM d_date) - INTERVAL 90 DAY)
    ORDER BY customer_id"""


@query("q4_inactive_customers", Q4_SQL)
def q4(t):
    return analytics.inactive_customers(
        bridge.fact_sales(t), bridge.dim_date(t), bridge.dim_customer(t)
    )


Q4_HISTORY_SQL = f"""WITH {s.HISTORY}, {s.FACT}, {s.DIM_DATE},
    recent AS (SELECT DISTINCT f.customer_key AS original FROM fact f JOIN d_date USING (date_key)
      WHERE full_date >= (SELECT max(full_date) FROM d_date) - INTERVAL 90 DAY),
    active AS (SELECT DISTINCT customer_id FROM history
      WHERE (customer_key - 1) // 10 IN (SELECT original FROM recent))
    SELECT customer_key, customer_id, customer_name, email, city, state, customer_segment,
           effective_from
    FROM history WHERE effective_to = DATE '9999-12-31'
      AND customer_id NOT IN (SELECT customer_id FROM active)
    ORDER BY customer_id"""


def _old_versions_sell(t):
    """Sales of which every one belongs to a customer's first version."""
    return bridge.fact_sales(t).withColumn("customer_key", F.col("customer_key") * 10 + 1)


@query("q4_inactive_by_customer_id", Q4_HISTORY_SQL)
def q4_by_id(t):
    """Customers with several versions; orders of all versions count."""
    history = bridge.customer_history(t).withColumn(
        "is_current", F.col("effective_to") == F.lit("9999-12-31").cast("date")
    )
    return analytics.inactive_customers(
        _old_versions_sell(t), bridge.dim_date(t), history, by="customer_id"
    )


MONTHS_SQL = f"""{STAR}, cm AS (
      SELECT category, CAST(date_trunc('month', full_date) AS DATE) AS month,
             round(sum(sales_amount), 2) AS revenue
      FROM fact JOIN d_product USING (product_key) JOIN d_date USING (date_key) GROUP BY 1, 2)"""

COMPARE_SQL = f"""{MONTHS_SQL},
    latest AS (SELECT max(month) AS m FROM cm),
    previous AS (SELECT max(month) AS m FROM cm WHERE month < (SELECT m FROM latest)),
    pair AS (
      SELECT p.category, CAST(p.revenue AS DOUBLE) AS previous_month_revenue,
             coalesce(CAST(l.revenue AS DOUBLE), 0.0) AS latest_month_revenue
      FROM (SELECT * FROM cm WHERE month = (SELECT m FROM previous)) p
      LEFT JOIN (SELECT * FROM cm WHERE month = (SELECT m FROM latest)) l USING (category))"""


Q5_SQL = f"""WITH {COMPARE_SQL}
    SELECT category, previous_month_revenue, latest_month_revenue,
           latest_month_revenue - previous_month_revenue AS revenue_change,
           CASE WHEN previous_month_revenue <> 0
                THEN (latest_month_revenue - previous_month_revenue) / previous_month_revenue
                     * 100.0 END AS change_percent
    FROM pair WHERE latest_month_revenue - previous_month_revenue < 0
    ORDER BY revenue_change, category"""


@query("q5_declining_categories", Q5_SQL)
def q5(t):
    return analytics.declining_categories(
        bridge.fact_sales(t), bridge.dim_product(t), bridge.dim_date(t)
    )


Q6_SQL = f"""WITH {STAR} SELECT category, {s.money('sales_amount')} AS revenue
    FROM fact JOIN d_product USING (product_key) JOIN d_date USING (date_key)
    WHERE full_date >= DATE '1996-01-01' AND full_date < DATE '1997-01-01'
    GROUP BY category ORDER BY category"""


@query("q6_category_revenue_range", Q6_SQL)
def q6(t):
    return analytics.category_revenue(
        bridge.fact_sales(t), bridge.dim_product(t), bridge.dim_date(t), "1996-01-01", "1997-01-01"
    )


def _by_month(t):
    """The fact written to a folder per month, and read back."""
    path = run_dir(t.spark, "fact-by-month")
    analytics.load_fact_by_month(bridge.fact_sales(t), path)
    return read_table(t.spark, path)


@query("q5_declining_by_month_folder", Q5_SQL)
def q5_by_month(t):
    """Only the folders of the last months are read."""
    return analytics.declining_categories(_by_month(t), bridge.dim_product(t), bridge.dim_date(t))


@query("q6_revenue_by_month_folder", Q6_SQL)
def q6_by_month(t):
    """Only the folders of the months that the date dimension chooses are read."""
    return analytics.category_revenue(
        _by_month(t), bridge.dim_product(t), bridge.dim_date(t), "1996-01-01", "1997-01-01"
    )


# --- joins and filters inside the questions -------------------------------------


@query(
    "jn_inner_equi",
    f"""WITH {s.FACT}, {s.DIM_PRODUCT} SELECT category, count(*) AS sales
    FROM fact JOIN d_product USING (product_key) GROUP BY category""",
)
def inner_equi(t):
    fact, products = bridge.fact_sales(t, with_order=False), bridge.dim_product(t)
    return aggregates.count_by(fact.join(products, "product_key"), ["category"], "sales")


@query(
    "jn_anti_recent",
    f"""WITH {s.FACT}, {s.DIM_DATE} SELECT c_custkey AS customer_key FROM customer
    WHERE c_custkey NOT IN (SELECT customer_key FROM fact JOIN d_date USING (date_key)
      WHERE full_date >= (SELECT max(full_date) FROM d_date) - INTERVAL 90 DAY)""",
)
def anti_recent(t):
    return q4(t).select("customer_key")


@query(
    "flt_recent_90d",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS full_date FROM orders
    WHERE CAST(o_orderdate AS DATE)
          >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 90 DAY""",
)
def recent(t):
    orders = t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("full_date")
    )
    cutoff = orders.agg(F.date_sub(F.max("full_date"), analytics.INACTIVE_DAYS)).scalar()
    return orders.filter(F.col("full_date") >= cutoff)


@query(
    "flt_latest_prev_period",
    f"""WITH {MONTHS_SQL} SELECT category, month, CAST(revenue AS DOUBLE) AS revenue FROM cm
    WHERE month IN (SELECT DISTINCT month FROM cm ORDER BY month DESC LIMIT 2)""",
)
def latest_two(t):
    fact = bridge.fact_sales(t)
    days = analytics.last_months(fact, bridge.dim_date(t))
    return analytics.category_months(fact, bridge.dim_product(t), days)


@query(
    "jn_period_compare",
    f"""WITH {COMPARE_SQL} SELECT * FROM pair""",
)
def period_compare(t):
    return analytics.compare_last_months(
        bridge.fact_sales(t), bridge.dim_product(t), bridge.dim_date(t)
    )


# --- aggregates -------------------------------------------------------------------


@query(
    "ag_sum_group",
    f"""WITH {s.ORDERS} SELECT order_status, payment_method, store_id,
           {s.money('quantity * unit_price')} AS revenue, CAST(sum(quantity) AS BIGINT) AS units
    FROM r_orders GROUP BY ALL""",
)
def sum_group(t):
    orders = bridge.order_lines(t).withColumn("amount", F.col("quantity") * F.col("unit_price"))
    return aggregates.sum_by(
        orders, ["order_status", "payment_method", "store_id"], "amount", "quantity"
    )


@query(
    "ag_nunique",
    f"""WITH {s.ORDERS} SELECT customer_id, count(DISTINCT order_id) AS orders
    FROM r_orders GROUP BY customer_id""",
)
def nunique(t):
    return aggregates.distinct_by(bridge.order_lines(t), ["customer_id"], "order_id", "orders")


@query(
    "ag_count_group",
    f"""WITH {s.ORDERS} SELECT order_id, count(*) AS rows FROM r_orders
    GROUP BY order_id HAVING count(*) > 1""",
)
def count_group(t):
    return aggregates.count_by(bridge.order_lines(t), ["order_id"], "rows", more_than=1)


@query(
    "ag_order_summary_status",
    f"""WITH {s.ORDERS} SELECT order_date, order_status, count(order_id) AS total_orders,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           {s.money('quantity * unit_price')} AS total_order_amount
    FROM r_orders GROUP BY order_date, order_status""",
)
def summary_status(t):
    from tillwright.operators.clean import order_amount

    return aggregates.order_summary_status(order_amount(bridge.order_lines(t)))


@query(
    "ag_order_summary_daily",
    f"""WITH {s.ORDERS} SELECT order_date, count(DISTINCT order_id) AS total_orders,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           {s.money('quantity * unit_price')} AS total_sales
    FROM r_orders GROUP BY order_date""",
)
def summary_daily(t):
    orders = bridge.order_lines(t).withColumn(
        "total_amount", F.col("quantity") * F.col("unit_price")
    )
    return aggregates.order_summary_daily(orders)


@query(
    "ag_scalar_minmax",
    """SELECT CAST(min(o_orderdate) AS DATE) AS min_order_date,
              CAST(max(o_orderdate) AS DATE) AS max_order_date FROM orders""",
)
def minmax(t):
    return aggregates.bounds(
        t.orders.select(F.col("o_orderdate").cast("date").alias("order_date")), "order_date"
    )


@query(
    "ag_status_counts",
    """SELECT o_orderstatus AS order_status, count(*) AS order_count FROM orders
    WHERE o_orderstatus IS NOT NULL GROUP BY 1""",
)
def status_counts(t):
    orders = t.orders.select(F.col("o_orderstatus").alias("order_status"))
    return aggregates.value_counts(orders, "order_status", "order_count")


@query(
    "ag_business_stats",
    f"""WITH {s.ORDERS} SELECT count(*) AS total_orders,
           {s.money('quantity * unit_price')} AS total_revenue,
           {s.money('quantity * unit_price')} / count(unit_price) AS average_order_value
    FROM r_orders""",
)
def business_stats(t):
    orders = bridge.order_lines(t).withColumn(
        "total_amount", F.col("quantity") * F.col("unit_price")
    )
    return aggregates.business_stats(orders)


@query(
    "ag_dim_measure",
    """SELECT event_type, round(sum(value), 4) AS value
    FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY event_type""",
)
def dim_measure(t):
    found = aggregates.measure_by(t.events, "event_type", "value")
    return found.withColumn("value", F.round("value", 4))


GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "ag_warehouse_overview",
    "WITH r AS ("
    + " UNION ALL ".join(
        f"SELECT (SELECT count(*) FROM {n}) AS n, (SELECT count(*) FROM (DESCRIBE {n})) AS c"
        for n in GIVEN
    )
    + """) SELECT count(*) AS tables, CAST(sum(n) AS BIGINT) AS total_rows,
          CAST(sum(c) AS BIGINT) AS total_columns FROM r""",
)
def warehouse_overview(t):
    return aggregates.overview({n: t.read(n) for n in GIVEN})


@query(
    "ag_distinct_points",
    f"""WITH {s.ORDERS} SELECT count(DISTINCT product_id) AS points FROM r_orders""",
)
def points(t):
    return aggregates.distinct_points(bridge.order_lines(t), "product_id")


# --- windows ------------------------------------------------------------------------


@query(
    "wn_lag_mom",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
      FROM orders GROUP BY 1),
    l AS (SELECT *, lag(revenue) OVER (ORDER BY month) AS previous_revenue FROM m)
    SELECT month, revenue, previous_revenue,
           CASE WHEN previous_revenue <> 0
                THEN (revenue - previous_revenue) / previous_revenue * 100.0 END AS growth_percent
    FROM l""",
)
def lag_mom(t):
    return windows.change_to_previous(_order_months(t), "month", "revenue")


def _order_months(t, *group):
    orders = t.orders.withColumn("month", month_start(F.col("o_orderdate").cast("date")))
    return aggregates.sum_by(orders, [*group, "month"], "o_totalprice")


@query(
    "wn_dense_rank",
    """SELECT p_partkey, p_retailprice,
           dense_rank() OVER (ORDER BY p_retailprice DESC) AS price_rank FROM part""",
)
def dense(t):
    return windows.dense_rank_by(
        t.part.select("p_partkey", "p_retailprice"), "p_retailprice", "price_rank"
    )


@query(
    "wn_keep_last",
    f"""WITH {s.ORDERS} SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY arrived_on DESC NULLS LAST,
        customer_id DESC NULLS LAST, product_id DESC NULLS LAST, order_date DESC NULLS LAST,
        quantity DESC NULLS LAST, unit_price DESC NULLS LAST, payment_method DESC NULLS LAST,
        order_status DESC NULLS LAST, store_id DESC NULLS LAST, discount DESC NULLS LAST) AS rn
      FROM r_orders) WHERE rn = 1""",
)
def keep_last(t):
    return windows.keep_last(bridge.order_lines(t), ["order_id"], ["arrived_on"])


@query(
    "wn_latest_by_ts",
    """SELECT user_id, updated_at, event_type, value FROM (
      SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS updated_at, event_type, value,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
               event_type <> 'error' DESC, event_type DESC, value DESC) AS rn FROM events)
    WHERE rn = 1""",
)
def latest_by_ts(t):
    changes = bridge.user_changes(t).select("user_id", "updated_at", "event_type", "value")
    errors = F.col("event_type") == "error"
    return windows.latest_by(
        changes.filter(errors), changes.filter(~errors), ["user_id"], "updated_at"
    )


@query(
    "wn_surrogate_key",
    f"""WITH {s.CUSTOMERS} SELECT row_number() OVER (ORDER BY customer_id) AS customer_key,
           customer_id, customer_name FROM r_customers""",
)
def surrogate(t):
    people = bridge.customers(t, signup=False).select("customer_id", "customer_name")
    return windows.number_rows(people, ["customer_id"], "customer_key")


@query(
    "wn_key_continue",
    """SELECT (SELECT max(c_custkey) FROM customer WHERE c_acctbal >= 0)
           + row_number() OVER (ORDER BY c_name) AS customer_key, c_name AS customer_name
    FROM customer WHERE c_acctbal < 0""",
)
def key_continue(t):
    people = t.customer.select(
        F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"), "c_acctbal"
    )
    known = people.filter("c_acctbal >= 0")
    new = people.filter("c_acctbal < 0").select("customer_name")
    return windows.continue_keys(new, known, "customer_key", ["customer_name"])


@query(
    "wn_rank_sql",
    """SELECT c_nationkey, c_custkey, c_acctbal, CAST(rank_in_group AS INTEGER) AS rank_in_group
    FROM (SELECT c_nationkey, c_custkey, c_acctbal, rank() OVER (
            PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank_in_group FROM customer)
    WHERE rank_in_group <= 3""",
)
def rank_sql(t):
    return windows.top_per_group(
        t.customer.select("c_nationkey", "c_custkey", "c_acctbal"),
        ["c_nationkey"],
        [F.col("c_acctbal").desc()],
        3,
        "rank",
    )


@query(
    "wn_running_total",
    """WITH m AS (SELECT o_orderstatus AS order_status,
             CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM orders GROUP BY 1, 2)
    SELECT order_status, month, CAST(revenue AS DOUBLE) AS revenue,
           CAST(sum(revenue) OVER (PARTITION BY order_status ORDER BY month) AS DOUBLE)
             AS running_total FROM m""",
)
def running(t):
    months = t.orders.groupBy(
        F.col("o_orderstatus").alias("order_status"),
        month_start(F.col("o_orderdate").cast("date")).alias("month"),
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))
    totals = windows.running_total(months, ["order_status"], "month", "revenue")
    return totals.withColumns(
        {n: F.col(n).cast("double") for n in ("revenue", "running_total")}
    )


PRODUCT_REVENUE_SQL = """p AS (SELECT p_type AS category, p_partkey AS product_key,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


@query(
    "wn_pct_contribution",
    f"""WITH {PRODUCT_REVENUE_SQL}
    SELECT category, product_key, CAST(revenue AS DOUBLE) AS revenue,
           CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY category) AS DOUBLE)
             * 100.0 AS contribution_percent,
           CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) * 100.0 AS total_percent
    FROM p""",
)
def pct_contribution(t):
    by_key = t.lineitem.groupBy(F.col("l_partkey").alias("product_key")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue")
    )
    per_product = by_key.join(
        t.part.select(F.col("p_partkey").alias("product_key"), F.col("p_type").alias("category")),
        "product_key",
    ).select("category", "product_key", "revenue")
    shared = windows.contribution(per_product, "revenue", ["category"])
    return windows.contribution(shared, "revenue", name="total_percent").withColumn(
        "revenue", F.col("revenue").cast("double")
    )


@query(
    "wn_yoy",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
      FROM orders GROUP BY 1)
    SELECT a.month, a.revenue, b.revenue AS previous_year,
           CASE WHEN b.revenue <> 0 THEN (a.revenue - b.revenue) / b.revenue * 100.0 END
             AS yoy_percent
    FROM m a LEFT JOIN m b ON a.month = b.month + INTERVAL 12 MONTH""",
)
def yoy(t):
    return windows.year_over_year(_order_months(t), "month", "revenue")


# --- sort and top-k -------------------------------------------------------------------


@query(
    "so_topk",
    """SELECT l_partkey AS product_key,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           CAST(sum(l_quantity) AS BIGINT) AS units
    FROM lineitem GROUP BY 1 ORDER BY revenue DESC, product_key LIMIT 10""",
)
def topk(t):
    lines = t.lineitem.select(
        F.col("l_partkey").alias("product_key"),
        "l_extendedprice",
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    sums = aggregates.sum_by(lines, ["product_key"], "l_extendedprice", "q")
    return ordering.top(sums, "revenue", ["product_key"], analytics.TOP_PRODUCTS)


@query(
    "so_multi",
    """SELECT c_mktsegment, c_acctbal, c_custkey FROM customer
    ORDER BY c_mktsegment, c_acctbal DESC, c_custkey""",
)
def sort_multi(t):
    return ordering.sort_by(
        t.customer.select("c_mktsegment", "c_acctbal", "c_custkey"),
        "c_mktsegment",
        "-c_acctbal",
        "c_custkey",
    )


@query(
    "so_chrono",
    f"""WITH {s.RAW_ORDERS} SELECT order_date, count(*) AS orders FROM raw_o
    GROUP BY order_date ORDER BY order_date""",
)
def chrono(t):
    days = aggregates.count_by(bridge.raw_orders(t), ["order_date"], "orders")
    return ordering.sort_chronologically(days, "order_date")


@query(
    "so_topn_cap",
    f"""WITH {s.FACT} SELECT CAST(store_key AS VARCHAR) AS store, {s.money('sales_amount')}
      AS revenue FROM fact GROUP BY 1 ORDER BY revenue DESC, store LIMIT 20""",
)
def topn_cap(t):
    fact = bridge.fact_sales(t).withColumn("store", F.col("store_key").cast("string"))
    return ordering.top(aggregates.sum_by(fact, ["store"], "sales_amount"), "revenue", ["store"], 20)


@query(
    "so_topn_other",
    """WITH g AS (SELECT p_brand AS brand,
             sum(l_extendedprice) AS revenue
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, brand) AS rn,
                 count(*) OVER () AS n FROM g)
    SELECT CASE WHEN n <= 12 OR rn <= 10 THEN brand ELSE 'Other' END AS brand,
           round(sum(revenue), 3) AS revenue
    FROM r GROUP BY 1 HAVING sum(revenue) <> 0""",
)
def topn_other(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("brand"), F.col("l_extendedprice").alias("revenue")
    )
    found = ordering.top_with_other(
        aggregates.measure_by(lines, "brand", "revenue"), "brand", "revenue"
    )
    return found.withColumn("revenue", F.round("revenue", 3))


@query(
    "so_result_cap",
    """SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey
    ORDER BY orders DESC, o_custkey LIMIT 500""",
)
def result_cap(t):
    counts = aggregates.count_by(t.orders, ["o_custkey"], "orders")
    return ordering.cap_rows(ordering.sort_by(counts, "-orders", "o_custkey"))


# --- ad-hoc SQL and query templates ------------------------------------------------------

ADHOC = """WITH monthly AS (
      SELECT c.city, date_trunc('month', o.order_date) AS month,
             sum(CAST(o.quantity * o.unit_price AS DECIMAL(18,2))) AS revenue
      FROM sales_orders o JOIN sales_customers c ON o.customer_id = c.customer_id
      GROUP BY c.city, date_trunc('month', o.order_date)
      HAVING count(*) > 1),
    ranked AS (
      SELECT city, month, revenue,
             row_number() OVER (PARTITION BY city ORDER BY revenue DESC, month) AS position
      FROM monthly)
    SELECT city, CAST(month AS DATE) AS month, CAST(revenue AS DOUBLE) AS revenue,
           CASE WHEN position = 1 THEN 'best' ELSE 'good' END AS grade
    FROM ranked WHERE position <= 5 AND revenue > (SELECT avg(revenue) FROM monthly)
    ORDER BY city, month"""


@query(
    "sql_adhoc",
    f"""WITH {s.CUSTOMERS}, {s.ORDERS}, sales_orders AS (SELECT * FROM r_orders),
    sales_customers AS (SELECT * FROM r_customers), {ADHOC.removeprefix('WITH ')} LIMIT 500""",
)
def sql_adhoc(t):
    return adhoc.run_sql(
        t.spark,
        ADHOC,
        {
            "sales_orders": bridge.order_lines(t),
            "sales_customers": bridge.customers(t, signup=False),
        },
    )


def _template(t, dimension):
    """Measure by one attribute of a dimension."""
    people = bridge.customers(t, signup=False)
    orders = bridge.order_lines(t).join(people, "customer_id")
    orders = orders.withColumn("amount", F.col("quantity") * F.col("unit_price"))
    return aggregates.sum_by(orders, [dimension], "amount", "quantity")


for _name in ("customer_segment", "store_id"):
    query(
        f"template_sales_by_{_name}",
        f"""WITH {s.CUSTOMERS}, {s.ORDERS} SELECT {_name},
               {s.money('quantity * unit_price')} AS revenue,
               CAST(sum(quantity) AS BIGINT) AS units
        FROM r_orders JOIN r_customers USING (customer_id) GROUP BY {_name}""",
    )(lambda t, _n=_name: _template(t, _n))


@query(
    "template_product_months",
    f"""WITH {STAR} SELECT product_name, CAST(date_trunc('month', full_date) AS DATE) AS month,
           {s.money('sales_amount')} AS revenue
    FROM fact JOIN d_product USING (product_key) JOIN d_date USING (date_key)
    GROUP BY 1, 2""",
)
def product_months(t):
    """The monthly series of every product name."""
    fact = bridge.fact_sales(t).join(bridge.dim_date(t).select("date_key", "full_date"), "date_key")
    by_key = aggregates.sum_by(
        month_column(fact), ["product_key", "month"], "sales_amount", final=False
    )
    names = bridge.dim_product(t).select("product_key", "product_name")
    return aggregates.sum_by(by_key.join(names, "product_key"), ["product_name", "month"], "revenue")


@query(
    "jn_left_lookup",
    f"""WITH {s.FACT} SELECT coalesce(category, 'Unknown') AS category, count(*) AS sales
    FROM fact LEFT JOIN (SELECT p_partkey, p_type AS category FROM part WHERE p_size > 10)
      ON product_key = p_partkey GROUP BY 1""",
)
def left_lookup(t):
    large = t.part.filter("p_size > 10").select(
        F.col("p_partkey").alias("product_key"), F.col("p_type").alias("category")
    )
    fact = bridge.fact_sales(t, with_order=False)
    found = joins.lookup(fact, large, ["product_key"], {"category": "Unknown"})
    return aggregates.count_by(found, ["category"], "sales")
