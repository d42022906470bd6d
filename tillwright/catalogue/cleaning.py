"""Clean-up, casts and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.catalogue import fragments as s
from tillwright.catalogue.base import query
from tillwright.functions import dates
from tillwright.functions.dates import calendar_columns
from tillwright.operators import clean
from tillwright.schemas import CUSTOMER_COLUMNS, require_columns, validate_schema
from tillwright.sources import bridge

RUN_AT = "2024-02-01 06:00:00"

# Two-word and '#'-joined names: only the first letter of each blank-separated word.
TITLE = (
    "list_aggregate(list_transform(string_split({0}, ' '), "
    "lambda w: upper(w[1:1]) || lower(w[2:])), 'string_agg', ' ')"
)


@query("prj_clean_names", "SELECT p_partkey AS part_key, p_name AS part_name, p_size AS size FROM part")
def clean_names(t):
    messy = t.part.select(
        F.col("p_partkey").alias(" Part Key"),
        F.col("p_name").alias("PART-Name"),
        F.col("p_size").alias("Size "),
    )
    return clean.clean_names(messy)


@query("prj_require_columns", f"WITH {s.RAW_CUSTOMERS} SELECT * FROM raw_c")
def required(t):
    return require_columns(bridge.raw_customers(t), CUSTOMER_COLUMNS, "customers")


@query("prj_validate_schema", f"WITH {s.PRODUCTS} SELECT * FROM r_products")
def validated(t):
    contract = "product_id STRING, product_name STRING, category STRING, price DOUBLE"
    return validate_schema(bridge.products(t), contract, extra=True)


@query("prj_drop_index_cols", "SELECT p_partkey, p_name FROM part")
def drop_index(t):
    return clean.drop_index_columns(
        t.part.select(
            F.col("p_size").alias("Unnamed: 0"),
            F.col("p_partkey").alias("__index_level_0__"),
            "p_partkey",
            "p_name",
        )
    )


@query(
    "prj_null_to_string",
    """SELECT c_custkey, CAST(NULL AS VARCHAR) AS untyped, CAST(NULL AS VARCHAR) AS empty_number,
              CASE WHEN c_acctbal < 0 THEN c_acctbal END AS debt FROM customer""",
)
def null_to_string(t):
    """Columns without a value become text; a column with some values keeps its type."""
    df = t.customer.select(
        "c_custkey",
        F.lit(None).alias("untyped"),
        F.when(F.col("c_acctbal") < -100000, F.col("c_acctbal")).alias("empty_number"),
        F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")).alias("debt"),
    )
    return clean.empty_columns_to_string(clean.null_columns_to_string(df))


@query(
    "prj_id_normalise",
    f"""WITH {s.RAW_ORDERS} SELECT order_id, customer_id, product_id, trim(store_id) AS store_id
    FROM raw_o""",
)
def id_normalise(t):
    raw = bridge.raw_orders(t).select("order_id", "customer_id", "product_id", "store_id")
    return clean.normalise_ids(raw.withColumn("order_id", F.col("order_id").cast("bigint")))


@query("prj_cast_customer", f"WITH {s.CAST_CUSTOMERS} SELECT * FROM cast_c")
def cast_customer(t):
    return clean.cast_customers(bridge.raw_customers(t))


@query("prj_cast_product", f"WITH {s.CAST_PRODUCTS} SELECT * FROM cast_p")
def cast_product(t):
    return clean.cast_products(bridge.raw_products(t))


@query("prj_cast_order", f"WITH {s.CAST_ORDERS} SELECT * FROM cast_o")
def cast_order(t):
    return clean.cast_orders(bridge.raw_orders(t))


@query(
    "prj_cast_enriched",
    f"""WITH {s.RAW_ORDERS} SELECT CAST(order_id AS BIGINT) AS order_id,
           CAST(customer_id AS BIGINT) AS customer_id, TRY_CAST(quantity AS DOUBLE) AS quantity,
           CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date, order_status
    FROM raw_o""",
)
def cast_enriched(t):
    raw = bridge.raw_orders(t)
    return clean.cast_enriched(
        raw.select("order_id", "customer_id", "quantity", "order_date", "order_status")
    )


@query(
    "prj_title_case",
    f"""WITH {s.PRODUCTS} SELECT product_id, {TITLE.format('upper(product_name)')} AS product_name
    FROM r_products""",
)
def title_case(t):
    loud = bridge.products(t).select("product_id", F.upper("product_name").alias("product_name"))
    return clean.title_case(loud, "product_name")


@query(
    "prj_order_amount",
    f"""WITH {s.ORDERS} SELECT order_id, product_id, store_id, quantity * unit_price AS total_amount,
           {s.round2('quantity * unit_price')} AS order_amount FROM r_orders""",
)
def order_amount(t):
    orders = bridge.order_lines(t).select(
        "order_id", "product_id", "store_id", "quantity", "unit_price"
    )
    both = clean.order_amount(clean.order_amount(orders, "total_amount", False), "order_amount")
    return both.drop("quantity", "unit_price")


@query(
    "prj_order_calendar",
    f"""WITH {s.ORDERS} SELECT order_id, order_date, CAST(year(order_date) AS INTEGER) AS order_year,
           CAST(month(order_date) AS INTEGER) AS order_month FROM r_orders""",
)
def order_calendar(t):
    return clean.order_calendar(bridge.order_lines(t).select("order_id", "order_date"))


@query(
    "prj_processed_ts",
    f"""SELECT p_partkey, TIMESTAMP '{RUN_AT}' AS processed_timestamp FROM part""",
)
def processed_ts(t):
    return clean.stamp(t.part.select("p_partkey"), RUN_AT)


@query("prj_rename_name", "SELECT c_custkey, c_name AS customer_name FROM customer")
def rename_name(t):
    return clean.accept_customer_name(t.customer.select("c_custkey", F.col("c_name").alias("name")))


@query(
    "prj_date_normalise",
    f"""WITH {s.RAW_ORDERS} SELECT order_id, CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE)
           AS order_date, CAST(arrived_on AS DATE) AS arrived_on FROM raw_o""",
)
def date_normalise(t):
    """One column as text, one as timestamp; both become dates."""
    raw = bridge.raw_orders(t).select(
        "order_id", "order_date", F.col("arrived_on").cast("timestamp").alias("arrived_on")
    )
    return clean.normalise_day(clean.normalise_day(raw, "order_date"), "arrived_on")


@query(
    "prj_join_inputs",
    f"""WITH {s.ORDERS} SELECT order_id, customer_id, product_id, order_date, quantity, unit_price,
           order_status FROM r_orders""",
)
def join_inputs(t):
    orders, _, _ = clean.join_inputs(
        bridge.order_lines(t), bridge.customers(t, signup=False), bridge.products(t)
    )
    return orders


@query(
    "prj_date_dim_attrs",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
           CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
           strftime(d, '%A') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year
    FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
)
def date_attributes(t):
    return t.lineitem.select(F.col("l_shipdate").cast("date").alias("d")).select(
        *calendar_columns("d")
    )


@query(
    "prj_discount_default",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              coalesce(CASE WHEN l_discount > 0.05 THEN l_discount END, 0.0) AS discount
    FROM lineitem""",
)
def discount_default(t):
    lines = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("discount"),
    )
    return clean.default_discount(lines)


# Configuration of the two lookups below: region by nation-named store group.
REGION_BY_STORE = {"1": "West", "2": "South", "3": "West", "5": "North"}


@query(
    "prj_region_lookup",
    f"""SELECT CAST(s_suppkey AS VARCHAR) AS store_id, 'own' AS source,
           coalesce(r_name, 'Unknown') AS region
    FROM supplier LEFT JOIN (SELECT * FROM {s.PLACES}) ON s_nationkey = n_nationkey
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), 'map', CASE s_suppkey WHEN 1 THEN 'West' WHEN 2 THEN 'South'
           WHEN 3 THEN 'West' WHEN 5 THEN 'North' ELSE 'Unknown' END FROM supplier
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), 'id', CAST(s_suppkey AS VARCHAR) FROM supplier""",
)
def regions(t):
    """All three ways to find a region: the store's own, a configured map, the id."""
    ids = bridge.dim_store(t)
    found = {
        "own": clean.region_lookup(bridge.stores(t)),
        "map": clean.region_lookup(ids, REGION_BY_STORE),
        "id": clean.region_lookup(ids),
    }
    own, mapped, plain = (df.withColumn("source", F.lit(n)) for n, df in found.items())
    return own.unionByName(mapped).unionByName(plain)


@query(
    "prj_month_trunc",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders""",
)
def month_trunc(t):
    days = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("full_date"))
    return clean.month_column(days).drop("full_date")


@query(
    "fn_interval_arithmetic",
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due,
           CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS month_before,
           CAST(o_orderdate + INTERVAL 1 YEAR - INTERVAL 36 HOUR AS TIMESTAMP) AS reminder,
           CAST(o_orderdate + CAST(o_custkey % 50 AS INTEGER) * INTERVAL 1 MONTH + CAST(o_orderkey % 7 AS INTEGER) * INTERVAL 1 DAY AS DATE) AS by_row,
           date_diff('day', TIMESTAMP '1996-02-29', o_orderdate) AS days_since,
           o_orderdate >= TIMESTAMP '1998-08-02' - INTERVAL '3 months' AS recent FROM orders""",
)
def interval_arithmetic(t):
    """Days and times moved by constant intervals and by intervals of each row."""
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.shifted(day, days=30).cast("date").alias("due"),
        dates.shifted(day, months=-1).cast("date").alias("month_before"),
        dates.shifted(day, months=12, hours=-36).alias("reminder"),
        dates.shifted(
            day, days=(F.col("o_orderkey") % 7).cast("int"), months=(F.col("o_custkey") % 50).cast("int")
        ).cast("date").alias("by_row"),
        dates.whole_days(F.lit("1996-02-29").cast("timestamp_ntz"), day).alias("days_since"),
        (day >= dates.shifted(F.lit("1998-08-02").cast("timestamp_ntz"), months=-3)).alias("recent"),
    )
