"""Sources and sinks. Sinks write to the shared folder and the result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.catalogue import fragments as s
from tillwright.catalogue.base import query
from tillwright.operators.quality import product_rules, split_valid
from tillwright.operators.clean import cast_products
from tillwright.plans import analytics
from tillwright.schemas import SchemaError
from tillwright.session import run_dir
from tillwright.sources import bridge, files, publish, sinks, storage, tables

RAW_TEXT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _write_text(df, path, *folders):
    writer = df.write.options(**RAW_TEXT)
    (writer.partitionBy(*folders) if folders else writer).csv(path)


@query("src_csv_text", f"WITH {s.RAW_CUSTOMERS} SELECT * FROM raw_c")
def csv_text(t):
    path = run_dir(t.spark, "csv-text")
    raw = bridge.raw_customers(t)
    _write_text(
        raw.withColumnsRenamed({"customer_id": "Customer ID", "customer_name": "customer-name"}),
        path,
    )
    return files.read_csv_text(t.spark, path)


# A line per product: some lack their last field, some have one too many because a comma
# is not quoted.
LINES_SQL = """lines AS (SELECT p_partkey, p_size,
      CASE WHEN p_size = 1 THEN p_partkey || ',' || p_name
           WHEN p_size = 2 THEN p_partkey || ',' || p_name || ',' || p_brand || ',' || p_size
           WHEN p_size = 3 THEN CAST(p_partkey AS VARCHAR)
           WHEN p_size = 4 THEN p_partkey || ',"' || p_name || ', new",' || p_brand
           ELSE p_partkey || ',' || p_name || ',' || p_brand END AS line,
      CASE WHEN p_size = 4 THEN p_name || ', new' ELSE p_name END AS name, p_brand
    FROM part)"""


@query(
    "src_csv_malformed",
    f"""WITH {LINES_SQL} SELECT CASE WHEN p_size > 3 THEN 'good' ELSE 'bad' END AS outcome,
           CASE WHEN p_size > 3 THEN CAST(p_partkey AS VARCHAR) END AS product_id,
           CASE WHEN p_size > 3 THEN name END AS product_name,
           CASE WHEN p_size > 3 THEN p_brand END AS supplier,
           CASE WHEN p_size <= 3 THEN line END AS line, 1 AS files FROM lines""",
)
def csv_malformed(t):
    """Broken lines keep their text and file, the others their fields; none is lost."""
    path = run_dir(t.spark, "malformed")
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    new_name = F.concat(F.lit('"'), F.col("p_name"), F.lit(', new"'))
    line = (
        F.when(size == 1, F.concat_ws(",", key, "p_name"))
        .when(size == 2, F.concat_ws(",", key, "p_name", "p_brand", size))
        .when(size == 3, key)
        .when(size == 4, F.concat_ws(",", key, new_name, "p_brand"))
        .otherwise(F.concat_ws(",", key, "p_name", "p_brand"))
    )
    t.part.select(line.alias("value")).write.text(path)
    checked = files.read_csv_checked(t.spark, path, ["product_id", "product_name", "supplier"], header=False)
    good, bad = files.split_lines(checked)
    of_file = F.when(F.col("file").contains("/malformed-"), 1).otherwise(0)
    return good.select(
        F.lit("good").alias("outcome"), "product_id", "product_name", "supplier",
        F.lit(None).cast("string").alias("line"), F.lit(1).alias("files"),
    ).unionByName(
        bad.select(F.lit("bad").alias("outcome"), "line", of_file.alias("files")), allowMissingColumns=True
    )


@query(
    "src_csv_chunked",
    f"""WITH {s.RAW_ORDERS} SELECT order_id, product_id, quantity, order_status FROM raw_o
    WHERE order_status IN ('f', 'o')""",
)
def csv_selected(t):
    """Only the chosen folders are read."""
    path = run_dir(t.spark, "csv-selected")
    raw = bridge.raw_orders(t).select("order_id", "product_id", "quantity", "order_status")
    _write_text(raw.withColumn("part", F.col("order_status")), path, "part")
    chosen = [f"{path}/part=f", f"{path}/part=o"]
    return files.read_csv_text(t.spark, chosen, raw.columns)


@query("src_format_switch", "SELECT c_custkey, c_nationkey, c_acctbal, c_name, 'csv' AS format FROM customer UNION ALL SELECT c_custkey, c_nationkey, c_acctbal, c_name, 'parquet' FROM customer")
def format_switch(t):
    path = run_dir(t.spark, "format")
    people = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_name")
    people.write.option("header", True).csv(f"{path}/csv")
    people.write.parquet(f"{path}/parquet")
    both = [
        files.read_source(t.spark, f"{path}/{kind}", kind).select(
            F.col("c_custkey").cast("bigint"), "c_nationkey", "c_acctbal", "c_name",
            F.lit(kind).alias("format"),
        )
        for kind in ("csv", "parquet")
    ]
    return both[0].unionByName(both[1])


@query(
    "src_parquet_tree",
    """SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name, p_retailprice AS price FROM part
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def parquet_tree(t):
    """Two loads of one table: the second has a narrower id and lacks a column."""
    path = run_dir(t.spark, "tree")
    t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    ).write.parquet(f"{path}/load=1/deep")
    t.supplier.select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name")
    ).write.parquet(f"{path}/load=2")
    return files.read_parquet_tree(t.spark, path)


@query("src_table_scan", "SELECT * FROM supplier")
def table_scan(t):
    tables.register({"scanned_supplier": t.supplier})
    return tables.scan(t.spark, "scanned_supplier")


@query("src_columns_only", "SELECT o_custkey FROM orders")
def columns_only(t):
    return files.read_columns(t.orders, "o_custkey")


@query(
    "src_view_register",
    """SELECT r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def view_register(t):
    tables.register({f"v_{n}": t.read(n) for n in ("customer", "nation", "region")})
    return t.spark.sql(
        "SELECT r_name, count(*) AS customers FROM v_customer "
        "JOIN v_nation ON c_nationkey = n_nationkey "
        "JOIN v_region ON n_regionkey = r_regionkey GROUP BY r_name"
    )


@query("src_preview", "SELECT (SELECT least(count(*), 10) FROM orders) AS shown, 6 AS columns")
def preview(t):
    """Which rows a preview shows is open; how many of how many columns is not."""
    shown = tables.preview({"orders": t.orders}, "orders", 10)
    return shown.agg(F.count(F.lit(1)).alias("shown"), F.lit(len(shown.columns)).alias("columns"))


@query(
    "src_path_parse",
    """WITH p AS (SELECT CASE o_orderstatus
        WHEN 'F' THEN 'raw/orders/' || strftime(o_orderdate, '%Y-%m-%d') || '/day%20' ||
                      o_custkey || '.csv'
        WHEN 'O' THEN 'Raw/orders/' || o_custkey || '.CSV'
        ELSE CASE o_orderpriority WHEN '5-LOW' THEN 'raw//' || o_custkey || '.csv'
             WHEN '1-URGENT' THEN 'raw/orders/a/b/' || o_custkey || '.csv'
             WHEN '2-HIGH' THEN 'other/orders/' || o_custkey || '.csv'
             ELSE 'raw/orders/' || o_custkey || '.json' END END AS path,
        o_orderstatus, o_custkey, o_orderdate FROM orders)
    SELECT path, 'orders' AS dataset,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END
             AS partition_date,
           CASE WHEN o_orderstatus = 'F' THEN 'day ' || o_custkey || '.csv'
                ELSE o_custkey || '.CSV' END AS file_name
    FROM p WHERE o_orderstatus IN ('F', 'O')""",
)
def path_parse(t):
    """One object path per order; pending orders have paths that are not valid."""
    key = F.col("o_custkey").cast("string")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    path = (
        F.when(status == "F", F.concat(F.lit("raw/orders/"), day, F.lit("/day%20"), key, F.lit(".csv")))
        .when(status == "O", F.concat(F.lit("Raw/orders/"), key, F.lit(".CSV")))
        .when(priority == "5-LOW", F.concat(F.lit("raw//"), key, F.lit(".csv")))
        .when(priority == "1-URGENT", F.concat(F.lit("raw/orders/a/b/"), key, F.lit(".csv")))
        .when(priority == "2-HIGH", F.concat(F.lit("other/orders/"), key, F.lit(".csv")))
        .otherwise(F.concat(F.lit("raw/orders/"), key, F.lit(".json")))
    )
    return files.parse_paths(t.orders.select(path.alias("path")))


@query("snk_append", "SELECT * FROM orders")
def append(t):
    """Two loads, told apart by a status; nulls come with the second."""
    path = run_dir(t.spark, "append")
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    for load in (first, ~first):
        sinks.append(t.orders.filter(load), path)
    return storage.read_table(t.spark, path)


@query("snk_processed_state", "SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P')")
def processed_state(t):
    """A first write, a write over it, and one added to it."""
    path = run_dir(t.spark, "processed")
    for status, add in (("F", False), ("O", False), ("P", True)):
        sinks.write_processed(t.orders.filter(F.col("o_orderstatus") == status), path, add)
    return storage.read_table(t.spark, path)


@query(
    "snk_quarantine",
    f"""WITH {s.CAST_PRODUCTS} SELECT product_id, product_name, category, price, supplier,
           'Schema or business validation failed' AS dq_reason
    FROM cast_p WHERE coalesce({s.BAD_PRODUCT}, FALSE)""",
)
def quarantine(t):
    """Rejects are appended once; an empty set of rejects writes nothing."""
    path = run_dir(t.spark, "quarantine")
    valid, rejected = split_valid(cast_products(bridge.raw_products(t)), product_rules())
    sinks.write_quarantine(rejected, path)
    sinks.write_quarantine(split_valid(valid, product_rules())[1], path)
    return t.spark.read.parquet(path).drop("failed_rules", "batch")


@query("snk_full_refresh", "SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer")
def full_refresh(t):
    """The second refresh reads the table it replaces."""
    path = run_dir(t.spark, "refresh")
    sinks.replace_table(t.customer.select("c_custkey", "c_acctbal"), path)
    old = storage.read_table(t.spark, path)
    sinks.replace_table(old.withColumn("c_acctbal", F.col("c_acctbal") + 1), path)
    return storage.read_table(t.spark, path)


@query("snk_append_checked", "SELECT * FROM part")
def append_checked(t):
    """Two loads that fit and one that does not."""
    path = run_dir(t.spark, "checked")
    sinks.append_checked(t.part.filter("p_size <= 25"), path)
    sinks.append_checked(t.part.filter("p_size > 25"), path)
    try:
        sinks.append_checked(t.part.withColumn("p_size", F.col("p_size").cast("string")), path)
    except SchemaError:
        return t.spark.read.parquet(path)
    raise AssertionError("a load of another type was accepted")


@query(
    "snk_partitioned",
    "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_day FROM orders",
)
def partitioned(t):
    path = run_dir(t.spark, "partitioned")
    orders = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("order_day"),
    )
    sinks.write_by_day(orders, path, "order_day")
    return storage.read_table(t.spark, path)


@query(
    "snk_daily_split",
    f"""WITH {s.CAST_CUSTOMERS} SELECT CAST(customer_id AS VARCHAR) AS customer_id, signup_date,
           customer_segment FROM cast_c WHERE signup_date IS NOT NULL""",
)
def daily_split(t):
    """Rows without a readable day are dropped; the folder is the day."""

    path = run_dir(t.spark, "daily")
    raw = bridge.raw_customers(t)
    sinks.split_daily(
        raw.select(
            F.regexp_extract("customer_id", r"^\s*(\d+)\s*$", 1).alias("customer_id"),
            "signup_date",
            F.upper("customer_segment").alias("customer_segment"),
        ),
        path,
    )
    found = t.spark.read.option("header", True).csv(path)
    same = F.col("signup_date").cast("date") == F.col("day").cast("date")
    return found.filter(same).select(
        "customer_id", F.col("signup_date").cast("date").alias("signup_date"), "customer_segment"
    )


@query(
    "snk_hive_path",
    f"""WITH {s.ORDERS}, {s.PRODUCTS} SELECT 'curated/sales/year=' || strftime(order_date, '%Y')
           || '/month=' || strftime(order_date, '%m') || '/day=' || strftime(order_date, '%d')
           || '/region=' || trim(payment_method) || '/category=' || category AS path,
           count(*) AS rows
    FROM r_orders JOIN r_products USING (product_id) GROUP BY 1""",
)
def hive_path(t):
    sales = bridge.order_lines(t).join(bridge.products(t), "product_id")
    path = sinks.hive_path(
        "curated/sales/", F.col("order_date"), F.col("payment_method"), F.col("category")
    )
    return sales.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "snk_csv_result",
    f"""WITH {s.FACT} SELECT n_name AS city, {s.money('sales_amount')} AS total_sales,
           CAST(count(DISTINCT sale_id) AS INTEGER) AS orders
    FROM fact JOIN customer ON customer_key = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name""",
)
def csv_result(t):
    path = run_dir(t.spark, "csv-result")
    people = bridge.customers(t, signup=False).withColumn(
        "customer_key", F.col("customer_id").cast("bigint")
    )
    sinks.write_csv(analytics.city_sales(bridge.fact_sales(t), people), path)
    return files.read_source(t.spark, path, "csv")


PUBLISHED = ("customer", "part", "orders")


def _published(t):
    base = run_dir(t.spark, "published")
    counts = publish.publish(t.spark, {n: t.read(n) for n in PUBLISHED}, base)
    return base, counts


@query(
    "snk_stage_verify_publish",
    " UNION ALL ".join(
        f"SELECT '{n}' AS published, count(*) AS rows FROM {n}" for n in PUBLISHED
    ),
)
def stage_verify_publish(t):
    base, _ = _published(t)
    frames = [
        publish.read_published(t.spark, base, n).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("published"), "rows"
        )
        for n in PUBLISHED
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "job_publish",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, o_orderpriority
    FROM orders""",
)
def job_publish(t):
    base, _ = _published(t)
    return publish.read_published(t.spark, base, "orders")


@query(
    "snk_export_normalise",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, strftime(ts, '%Y-%m-%d') AS day,
              CAST(event_type = 'error' AS INTEGER) AS failed,
              CASE WHEN event_type <> 'view' THEN value END AS value,
              CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
              '{"user_id":' || user_id || ',"kinds":["' || event_type || '"]}' AS nested,
              encode(event_type) AS payload
    FROM events""",
)
def export_normalise(t):
    nested = F.struct("user_id", F.array("event_type").alias("kinds"))
    value = F.when(F.col("event_type") == "view", float("nan")).otherwise(F.col("value"))
    return publish.relational_form(
        t.events.select(
            "event_id",
            "ts",
            F.col("ts").cast("date").alias("day"),
            (F.col("event_type") == "error").alias("failed"),
            value.alias("value"),
            F.col("value").cast("decimal(18,2)").alias("amount"),
            nested.alias("nested"),
            F.encode("event_type", "UTF-8").alias("payload"),
        )
    )


LOGGED = ("customer", "part", "orders", "lineitem")


@query(
    "snk_ingest_log",
    " UNION ALL ".join(
        f"SELECT '{n}.parquet' AS file_name, 'PARTIAL' AS processing_status, count(*) AS "
        f"record_count, 1.235 AS processing_time_seconds FROM {n}"
        for n in LOGGED
    ).replace("1.235", "CAST(1.235 AS DOUBLE)"),
)
def ingest_log(t):
    """One record per given table with its row count."""
    path = run_dir(t.spark, "ingest-log")
    for name in LOGGED:
        load = t.read(name).agg(F.count(F.lit(1)).alias("record_count")).select(
            "record_count",
            F.lit(f"{name}.parquet").alias("file_name"),
            F.lit("given").alias("source"),
            F.lit("partial").alias("processing_status"),
            F.lit(1.2349).alias("processing_time_seconds"),
            F.lit("1").alias("pipeline_version"),
            F.lit("2024-02-01").cast("timestamp").alias("ingestion_time"),
        )
        sinks.log_ingestion(load, path)
    return storage.read_table(t.spark, path).select(
        "file_name", "processing_status", "record_count", "processing_time_seconds"
    )
