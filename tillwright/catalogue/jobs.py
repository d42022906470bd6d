"""Whole jobs: zones, dimensions, fact, marts, monitoring, vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.catalogue import fragments as s
from tillwright.catalogue.base import query
from tillwright.catalogue.cleaning import RUN_AT, TITLE
from tillwright.catalogue.dataquality import EVENTS_SQL
from tillwright.operators import clean, vectors
from tillwright.operators.vector_index import VectorIndex
from tillwright.plans import curate, incremental, marts, monitoring, optimised_join, scd2, star
from tillwright.session import run_dir
from tillwright.sources import bridge
from tillwright.sources.sinks import replace_table
from tillwright.sources.storage import read_table
from tillwright.sources.tables import Warehouse
from tillwright.streaming import ledger

NEXT_AT = "2024-02-02 06:00:00"


def _zones(t, name):
    return Warehouse(t.spark, run_dir(t.spark, name))


CUSTOMERS_SQL = f"""{s.CAST_CUSTOMERS}, valid_c AS (
      SELECT * FROM cast_c WHERE NOT coalesce({s.BAD_CUSTOMER}, FALSE))"""
PRODUCTS_SQL = f"""{s.CAST_PRODUCTS}, valid_p AS (
      SELECT * FROM cast_p WHERE NOT coalesce({s.BAD_PRODUCT}, FALSE))"""


@query(
    "job_customers",
    f"""WITH {CUSTOMERS_SQL}
    SELECT CAST(customer_id AS VARCHAR) AS customer_id,
           upper(customer_name[1:1]) || lower(customer_name[2:]) AS customer_name, email, city,
           state, signup_date,
           CASE WHEN customer_segment = 'BUILDING' THEN 'PREMIUM' ELSE customer_segment END
             AS customer_segment,
           CASE WHEN customer_segment = 'BUILDING' THEN TIMESTAMP '{NEXT_AT}'
                ELSE TIMESTAMP '{RUN_AT}' END AS processed_timestamp
    FROM valid_c""",
)
def job_customers(t):
    """A full load, then one that changes the segment of some customers."""
    zones = _zones(t, "customers")
    raw = bridge.raw_customers(t)
    curate.load_customers(zones, raw, at=RUN_AT, batch="1")
    changed = raw.filter("customer_segment = 'building'").withColumn(
        "customer_segment", F.lit(" premium ")
    )
    curate.load_customers(zones, changed, at=NEXT_AT, batch="2")
    return zones.read("curated/customers")


INCREMENTAL_SQL = f"""WITH {CUSTOMERS_SQL},
    n AS (SELECT customer_segment AS segment, count(DISTINCT customer_id) AS rows
      FROM valid_c GROUP BY 1)
    SELECT 1 AS run, (SELECT count(*) FROM n WHERE segment <> 'FURNITURE') AS segments,
           CAST(sum(rows) AS BIGINT) AS rows FROM n WHERE segment <> 'FURNITURE'
    UNION ALL SELECT 2, 2, CAST(sum(rows) AS BIGINT) FROM n
      WHERE segment IN ('FURNITURE', 'BUILDING')
    UNION ALL SELECT 3, 0, 0
    UNION ALL SELECT 4, 1, CAST(sum(rows) AS BIGINT) FROM n WHERE segment = 'BUILDING'"""


@query("job_incremental", INCREMENTAL_SQL)
def job_incremental(t):
    """A first arrival, a new folder with a changed one, nothing new, a folder put back.

    Files lie in a folder per segment, as many as Spark writes. Each run loads and marks
    only what is new: the folders of its files are counted in the ledger, the rows are
    what it processed.
    """
    base = run_dir(t.spark, "incremental")
    text = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw = bridge.raw_customers(t).withColumn("part", F.lower(F.trim("customer_segment")))

    def arrive(parts):
        for part in parts:
            own = raw.filter(F.col("part") == part).drop("part")
            own.write.options(**text).mode("overwrite").csv(f"{base}/raw/customers/part-{part}")

    segments = [r["part"] for r in raw.select("part").distinct().collect()]
    arrivals = [[n for n in segments if n != "furniture"], ["furniture", "building"], [], ["building"]]
    runs = []
    for number, parts in enumerate(arrivals, 1):
        arrive(parts)
        at = f"2024-02-0{number} 06:00:00"
        (load,) = incremental.run(t.spark, f"{base}/raw", f"{base}/lake", at)
        book = ledger.read_ledger(Warehouse(t.spark, f"{base}/lake"))
        own = book.filter(F.col("processed_at") == F.lit(at).cast("timestamp"))
        folders = own.agg(F.count_distinct(F.substring_index("path", "/", 1))).first()[0]
        runs.append((number, folders, load.rows))
    return t.spark.createDataFrame(runs, "run int, segments bigint, rows bigint")


@query(
    "job_customers_quarantine",
    f"""WITH {s.CAST_CUSTOMERS} SELECT customer_id, customer_name, email, customer_segment,
           'Schema or business validation failed' AS dq_reason FROM cast_c
    WHERE coalesce({s.BAD_CUSTOMER}, FALSE)""",
)
def job_customers_quarantine(t):
    """What the customer job rejected, read back from the quarantine zone."""
    zones = _zones(t, "customers-rejected")
    curate.load_customers(zones, bridge.raw_customers(t), at=RUN_AT, batch="1")
    return zones.read("quarantine/customers").select(
        "customer_id", "customer_name", "email", "customer_segment", "dq_reason"
    )


@query(
    "job_products",
    f"""WITH {PRODUCTS_SQL} SELECT CAST(product_id AS VARCHAR) AS product_id,
           {TITLE.format('product_name')} AS product_name, category, price, supplier,
           TIMESTAMP '{RUN_AT}' AS processed_timestamp FROM valid_p""",
)
def job_products(t):
    zones = _zones(t, "products")
    curate.load_products(zones, bridge.raw_products(t), at=RUN_AT, batch="1")
    return zones.read("curated/products")


ORDERS_SQL = f"""{CUSTOMERS_SQL}, {PRODUCTS_SQL}, {s.CAST_ORDERS}, batched AS (
      SELECT *, CASE WHEN arrived_on < '2000-01-01' THEN 1 ELSE 2 END AS batch,
             upper(trim(operation)) IN ('DELETE', 'D') AS is_delete FROM cast_o),
    good AS (
      SELECT *, row_number() OVER (PARTITION BY batch, order_id ORDER BY arrived_on DESC,
          customer_id DESC, product_id DESC, order_date DESC, quantity DESC, unit_price DESC,
          payment_method DESC, order_status DESC, store_id DESC) AS rn
      FROM batched WHERE NOT is_delete AND NOT coalesce({s.BAD_ORDER}, FALSE)
        AND customer_id IN (SELECT customer_id FROM valid_c)
        AND product_id IN (SELECT product_id FROM valid_p)),
    curated_o AS (
      SELECT * FROM good g WHERE rn = 1 AND (batch = 2 OR (
        order_id NOT IN (SELECT order_id FROM batched WHERE is_delete AND batch = 2)
        AND order_id NOT IN (SELECT order_id FROM good WHERE batch = 2))))"""


def _load_orders(t, zones, summary=False):
    curate.load_customers(zones, bridge.raw_customers(t), at=RUN_AT, batch="1")
    curate.load_products(zones, bridge.raw_products(t), at=RUN_AT, batch="1")
    raw = bridge.raw_orders(t)
    for batch, part in (
        ("1", raw.filter("arrived_on < '2000-01-01'")),
        ("2", raw.filter("arrived_on >= '2000-01-01'")),
    ):
        curate.load_orders(zones, part, at=RUN_AT, batch=batch, arrival=["arrived_on"])
        if summary:
            curate.load_order_summary(zones, at=RUN_AT)


@query(
    "job_orders",
    f"""WITH {ORDERS_SQL} SELECT CAST(order_id AS VARCHAR) AS order_id,
           CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id,
           order_date, quantity, unit_price, payment_method, order_status, store_id,
           quantity * unit_price AS total_amount, {s.round2('quantity * unit_price')}
             AS order_amount, CAST(year(order_date) AS INTEGER) AS order_year,
           CAST(month(order_date) AS INTEGER) AS order_month, arrived_on, operation
    FROM curated_o""",
)
def job_orders(t):
    """Two arrivals: the second deletes and replaces orders of the first."""
    zones = _zones(t, "orders")
    _load_orders(t, zones)
    return zones.read("curated/orders").drop("processed_timestamp")


@query(
    "job_order_summary",
    f"""WITH {ORDERS_SQL} SELECT order_date, count(DISTINCT order_id) AS total_orders,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           {s.money('quantity * unit_price')} AS total_sales FROM curated_o GROUP BY order_date""",
)
def job_order_summary(t):
    """The summary is brought up to date after each of two arrivals."""
    zones = _zones(t, "summary")
    _load_orders(t, zones, summary=True)
    return zones.read("curated/order_summary").drop("processed_timestamp")


@query(
    "job_orders_quarantine",
    f"""WITH {ORDERS_SQL} SELECT dq_reason, count(*) AS rows FROM (
      SELECT CASE WHEN coalesce({s.BAD_ORDER}, FALSE) THEN 'Schema or business validation failed'
             WHEN customer_id NOT IN (SELECT customer_id FROM valid_c)
               OR product_id NOT IN (SELECT product_id FROM valid_p)
             THEN 'Customer ID or Product ID does not exist' END AS dq_reason
      FROM batched WHERE NOT is_delete) WHERE dq_reason IS NOT NULL GROUP BY dq_reason""",
)
def job_orders_quarantine(t):
    zones = _zones(t, "orders-rejected")
    _load_orders(t, zones)
    return zones.read("quarantine/orders").groupBy("dq_reason").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "job_orders_enriched",
    f"""WITH {s.RAW_ORDERS}, e AS (
      SELECT CAST(order_id AS BIGINT) AS id, CAST(customer_id AS BIGINT) AS customer_id,
             CAST(product_id AS BIGINT) AS product_id,
             CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
             TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
             store_id, arrived_on FROM raw_o),
    g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY arrived_on DESC,
            customer_id DESC NULLS LAST, product_id DESC, order_date DESC NULLS LAST,
            quantity DESC, unit_price DESC, store_id DESC) AS rn
      FROM e WHERE id IS NOT NULL AND quantity > 0 AND unit_price >= 0)
    SELECT CAST(id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
           CAST(product_id AS VARCHAR) AS product_id, order_date, quantity, unit_price,
           trim(store_id) AS store_id, arrived_on, quantity * unit_price AS total_amount
    FROM g WHERE rn = 1""",
)
def job_orders_enriched(t):
    """Only the columns at hand are cast and checked."""
    zones = _zones(t, "enriched")
    raw = bridge.raw_orders(t).drop("payment_method", "order_status", "operation")
    curate.load_enriched(zones, raw, at=RUN_AT, batch="1", arrival=["arrived_on"])
    return zones.read("curated/orders_enriched").drop("processed_timestamp")


# --- dimensions and fact ----------------------------------------------------------------


SCD2_SQL = f"""{s.CUSTOMERS}, first_day AS (SELECT CAST(min(o_orderdate) AS DATE) AS d FROM orders),
    v1 AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM r_customers
           WHERE balance >= 0),
    v2 AS (SELECT (SELECT max(customer_key) FROM v1) + row_number() OVER (ORDER BY customer_id)
             AS customer_key, * FROM r_customers WHERE balance < 0 OR balance > 9000),
    scd2 AS (
      SELECT customer_key, customer_id, customer_name, email, city, state, signup_date,
             customer_segment, (SELECT d FROM first_day) AS effective_from,
             CASE WHEN balance > 9000 THEN DATE '2001-08-31' ELSE DATE '9999-12-31' END
               AS effective_to, balance <= 9000 AS is_current, 1 AS version FROM v1
      UNION ALL
      SELECT customer_key, customer_id, customer_name, email,
             CASE WHEN balance > 9500 THEN 'ELSEWHERE' ELSE city END, state, signup_date,
             CASE WHEN balance > 9000 THEN 'PREMIUM' ELSE customer_segment END,
             DATE '2001-09-01', DATE '9999-12-31', TRUE,
             CASE WHEN balance > 9000 THEN 2 ELSE 1 END FROM v2)"""


@query("job_scd2_customer", f"WITH {SCD2_SQL} SELECT * FROM scd2")
def job_scd2(t):
    """First load, a run with new and changed customers, and a second run that day."""
    warehouse = _zones(t, "scd2")
    path = warehouse.path("dim_customer")
    first_day = t.orders.agg(F.min(F.col("o_orderdate").cast("date"))).first()[0]
    for number, run_day in ((1, "2001-08-15"), (2, "2001-09-01"), (3, "2001-09-01")):
        dim = scd2.build_customer_dimension(
            bridge.snapshot(t, number), warehouse.read_or_none("dim_customer"), first_day, run_day
        )
        replace_table(dim, path)
    return warehouse.read("dim_customer")


@query(
    "job_dim_product",
    f"""WITH {s.PRODUCTS} SELECT row_number() OVER (ORDER BY product_id) AS product_key, *
    FROM r_products""",
)
def job_dim_product(t):
    return star.product_dimension(bridge.products(t))


@query(
    "job_dim_store",
    f"""WITH {s.ORDERS} SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id
    FROM (SELECT DISTINCT store_id FROM r_orders)""",
)
def job_dim_store(t):
    return star.store_dimension(bridge.order_lines(t))


@query(
    "job_dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
           CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
           strftime(d, '%A') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
          WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))""",
)
def job_dim_date(t):
    return star.date_dimension(bridge.order_lines(t))


def _keyed_orders(t):
    """The orders, and the column that keeps the copies of an order together, if there is one."""
    keyed = bridge.one_key_per_number(t)
    return bridge.order_lines(t, keyed), bridge.ORDER_KEY if keyed else None


def _star(t):
    """The fact and its dimensions, with customer versions of different age."""
    orders, within = _keyed_orders(t)
    dim_store, dim_date = star.order_dimensions(orders)
    dims = {
        "dim_customer": bridge.customer_history(t),
        "dim_product": star.product_dimension(bridge.products(t)),
        "dim_store": dim_store,
        "dim_date": dim_date,
    }
    return star.build_fact(orders, *dims.values(), arrival=["arrived_on"], within=within), dims


def _stored_star(t):
    """The star as tables in a folder of this call; the marts read it from there."""
    base = run_dir(t.spark, "star")
    fact, dims = _star(t)
    tables = {"fact_sales": fact, **dims}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
    read = {n: t.spark.read.schema(df.schema).parquet(f"{base}/{n}") for n, df in tables.items()}
    return read.pop("fact_sales"), read


@query("job_fact_sales", f"WITH {s.STAR} SELECT * FROM star_fact")
def job_fact(t):
    return _star(t)[0]


@query(
    "job_verify_star",
    f"""WITH {s.STAR}, k AS (SELECT customer_id, count(*) AS n, count(*) FILTER (is_current) AS cur,
           count(*) FILTER (effective_from > effective_to) AS rev FROM history GROUP BY customer_id)
    SELECT 'customer_total_rows' AS "check", CAST(sum(n) AS BIGINT) AS rows FROM k
    UNION ALL SELECT 'customer_current_rows', CAST(sum(cur) AS BIGINT) FROM k
    UNION ALL SELECT 'customer_historical_rows', CAST(sum(n - cur) AS BIGINT) FROM k
    UNION ALL SELECT 'customer_bad_current_keys', count(*) FILTER (cur > 1) FROM k
    UNION ALL SELECT 'customer_bad_date_order', CAST(sum(rev) AS BIGINT) FROM k
    UNION ALL SELECT 'fact_total_rows', count(*) FROM star_fact
    UNION ALL SELECT 'fact_duplicate_sale_ids', count(sale_id) - count(DISTINCT sale_id)
      FROM star_fact""",
)
def job_verify(t):
    fact, dims = _star(t)
    return star.verify_star(fact, dims["dim_customer"])


@query(
    "ag_sales_summary",
    f"""WITH {s.STAR}, regions AS (SELECT CAST(s_suppkey AS VARCHAR) AS store_id, r_name AS region
      FROM supplier JOIN ({s.PLACES}) ON s_nationkey = n_nationkey)
    SELECT strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS date, region, category,
           count(DISTINCT sale_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           {s.money('sales_amount')} AS total_revenue
    FROM star_fact JOIN star_product USING (product_key) JOIN star_store USING (store_key)
    JOIN regions USING (store_id) GROUP BY ALL""",
)
def sales_summary(t):
    fact, dims = _stored_star(t)
    return marts.sales_summary(
        fact,
        dims["dim_date"],
        dims["dim_product"],
        dims["dim_store"],
        clean.region_lookup(bridge.stores(t)),
        unique=True,
    )


CUSTOMER_MART_SQL = f"""SELECT h.customer_id, count(DISTINCT sale_id) AS total_orders,
           {s.money('sales_amount')} AS total_spend,
           {s.round2(s.money('sales_amount') + ' / count(DISTINCT sale_id)')}
             AS average_order_value,
           CAST(strptime(CAST(max(date_key) AS VARCHAR), '%Y%m%d') AS DATE) AS last_order_date,
           max(c.customer_segment) AS customer_segment
    FROM star_fact f JOIN history h ON f.customer_key = h.customer_key
    JOIN (SELECT * FROM history WHERE is_current) c ON h.customer_id = c.customer_id
    GROUP BY h.customer_id"""


@query("ag_customer_analytics", f"WITH {s.STAR} {CUSTOMER_MART_SQL}")
def customer_analytics(t):
    fact, dims = _stored_star(t)
    return marts.customer_analytics(fact, dims["dim_date"], dims["dim_customer"], unique=True)


PRODUCT_MART_SQL = f"""SELECT *, dense_rank() OVER (ORDER BY total_revenue DESC) AS sales_rank FROM (
      SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
             {s.money('sales_amount')} AS total_revenue,
             {s.round2(s.money('sales_amount') + ' / sum(quantity)')} AS average_price
      FROM star_fact JOIN star_product USING (product_key) GROUP BY product_id)"""


@query("ag_product_analytics", f"WITH {s.STAR} {PRODUCT_MART_SQL}")
def product_analytics(t):
    fact, dims = _stored_star(t)
    return marts.product_analytics(fact, dims["dim_product"])


@query(
    "job_marts",
    f"""WITH {s.LAST_ORDERS}, {s.CUSTOMERS}, {s.PRODUCTS}
    SELECT 'mart_sales_summary' AS mart, count(*) AS rows, CAST(sum(revenue) AS DOUBLE) AS revenue
    FROM (SELECT order_date, store_id, category,
                 sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS revenue
          FROM last_orders JOIN r_products USING (product_id) GROUP BY 1, 2, 3)
    UNION ALL SELECT 'mart_customer_analytics', count(DISTINCT customer_id),
           {s.money('quantity * unit_price')} FROM last_orders
    UNION ALL SELECT 'mart_product_analytics', count(DISTINCT product_id),
           {s.money('quantity * unit_price')} FROM last_orders""",
)
def job_marts(t):
    """The star is loaded into a warehouse, then all marts from its tables.

    Without regions in the store dimension each store is its own region.
    """
    warehouse = _zones(t, "marts")
    orders, within = _keyed_orders(t)
    star.load_star(
        warehouse,
        bridge.customers(t),
        bridge.products(t),
        orders,
        "2001-09-01",
        ["arrived_on"],
        within,
    )
    marts.load_marts(warehouse, unique=True)

    def total(name, amount):
        return warehouse.read(name).agg(
            F.lit(name).alias("mart"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("revenue"),
        )

    return (
        total("mart_sales_summary", "total_revenue")
        .unionByName(total("mart_customer_analytics", "total_spend"))
        .unionByName(total("mart_product_analytics", "total_revenue"))
    )


@query(
    "job_optimised_join",
    f"""WITH {s.CUSTOMERS}, {s.PRODUCTS}, {s.ORDERS}
    SELECT order_id, order_date, customer_id, customer_name, city, state, customer_segment,
           product_id, product_name, category, quantity, unit_price, price AS product_price,
           order_status, quantity * unit_price AS sales_amount
    FROM r_orders JOIN r_customers USING (customer_id) JOIN r_products USING (product_id)
    WHERE order_status IS NOT NULL""",
)
def job_optimised(t):
    """Inputs from files, filter, joins, written by day and read back."""
    base = run_dir(t.spark, "optimised")
    inputs = {
        "orders": bridge.order_lines(t),
        "customers": bridge.customers(t, signup=False),
        "products": bridge.products(t),
    }
    for name, df in inputs.items():
        df.write.parquet(f"{base}/{name}")
    optimised_join.run(
        t.spark,
        *[f"{base}/{name}" for name in inputs],
        f"{base}/wide",
    )
    return read_table(t.spark, f"{base}/wide")


@query(
    "job_monitoring",
    f"""WITH {EVENTS_SQL} SELECT severity, event_type, count(*) AS events,
           count(DISTINCT run_id) AS runs FROM run_events GROUP BY ALL""",
)
def job_monitoring(t):
    """All runs are recorded, then the event log is read back and counted."""
    base = run_dir(t.spark, "monitoring")
    monitoring.record_runs(bridge.pipeline_runs(t), base)
    return t.spark.read.parquet(f"{base}/pipeline_events").groupBy("severity", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("run_id").alias("runs")
    )


RAG_SQL = """WITH q AS (SELECT CAST(label AS BIGINT) AS probe_id, min(vec_id) AS vec_id FROM embeddings GROUP BY label),
    p AS (SELECT probe_id, CAST(embedding AS DOUBLE[]) AS probe FROM q JOIN embeddings e USING (vec_id)),
    d AS (SELECT e.vec_id, probe_id, list_distance(CAST(embedding AS DOUBLE[]), probe) AS distance
      FROM embeddings e, p)
    SELECT vec_id, probe_id, CAST(round(CAST(distance AS DECIMAL(38,10)), 6) AS DOUBLE) AS distance,
           CAST(position AS INTEGER) AS position
    FROM (SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY distance, vec_id) AS position
          FROM d) WHERE position <= 5"""


@query("rag_topk", RAG_SQL)
def rag_topk(t):
    """The first vector of each label asks for its five nearest neighbours."""
    probes = t.embeddings.groupBy(F.col("label").alias("probe_id")).agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    )
    found = vectors.nearest(t.embeddings, probes, 5)
    return found.withColumn(
        "distance", F.round(F.col("distance").cast("decimal(38,10)"), 6).cast("double")
    )


@query("rag_topk_index", RAG_SQL)
def rag_topk_index(t):
    """The same from a stored index of cells, which rules out most pairs without a look."""
    probes = t.embeddings.groupBy(F.col("label").alias("probe_id")).agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    )
    index = VectorIndex.build(t.embeddings, run_dir(t.spark, "vector-index"))
    found = index.nearest(probes, 5).rows
    return found.withColumn(
        "distance", F.round(F.col("distance").cast("decimal(38,10)"), 6).cast("double")
    )
