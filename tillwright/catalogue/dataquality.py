"""Row rules, quarantine and data-quality reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tillwright.catalogue import fragments as s
from tillwright.catalogue.base import query
from tillwright.operators import clean, quality
from tillwright.plans import monitoring
from tillwright.schemas import FACT_COLUMNS
from tillwright.session import run_dir
from tillwright.sources import bridge

REASON = quality.RULE_REASON


def _raw_orders(t):
    return bridge.raw_orders(t)


@query("flt_customer_valid", f"WITH {s.CAST_CUSTOMERS} SELECT * FROM cast_c WHERE NOT coalesce({s.BAD_CUSTOMER}, FALSE)")
def customer_valid(t):
    return quality.split_valid(clean.cast_customers(bridge.raw_customers(t)), quality.customer_rules())[0]


@query("flt_product_valid", f"WITH {s.CAST_PRODUCTS} SELECT * FROM cast_p WHERE NOT coalesce({s.BAD_PRODUCT}, FALSE)")
def product_valid(t):
    return quality.split_valid(clean.cast_products(bridge.raw_products(t)), quality.product_rules())[0]


@query("flt_order_valid", f"WITH {s.CAST_ORDERS} SELECT * FROM cast_o WHERE NOT coalesce({s.BAD_ORDER}, FALSE)")
def order_valid(t):
    return quality.split_valid(clean.cast_orders(_raw_orders(t)), quality.order_rules())[0]


@query(
    "flt_enriched_valid",
    f"""WITH {s.RAW_ORDERS}, e AS (SELECT CAST(order_id AS BIGINT) AS order_id,
           TRY_CAST(quantity AS DOUBLE) AS quantity, product_id FROM raw_o)
    SELECT order_id, quantity, CAST(product_id AS BIGINT) AS product_id FROM e
    WHERE order_id IS NOT NULL AND quantity > 0""",
)
def enriched_valid(t):
    """No unit price column, so no unit price rule."""
    df = clean.cast_enriched(bridge.raw_orders(t).select("order_id", "quantity", "product_id"))
    return quality.split_valid(df, quality.enriched_rules(df.columns))[0]


@query(
    "flt_split_quarantine",
    f"""WITH {s.CAST_ORDERS} SELECT order_date, CASE WHEN coalesce({s.BAD_ORDER}, FALSE)
           THEN 'rejected' ELSE 'valid' END AS outcome, count(*) AS rows
    FROM cast_o GROUP BY ALL""",
)
def split_quarantine(t):
    """Both outputs of one write counted per day: every row is in exactly one."""
    classified = quality.classify(clean.cast_orders(_raw_orders(t)), quality.order_rules())
    found = quality.write_outcomes(
        classified.select("order_date", "failed_rules", "dq_reason"), run_dir(t.spark, "outcomes")
    )
    both = found.valid.select("order_date", F.lit("valid").alias("outcome")).unionByName(
        found.rejected.select("order_date", F.lit("rejected").alias("outcome"))
    )
    return both.groupBy("order_date", "outcome").agg(F.count(F.lit(1)).alias("rows"))


def _rule_list(pairs):
    cases = ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in pairs)
    return f"concat_ws(',', {cases})"


ORDER_RULES_SQL = _rule_list(
    [(f"{n}_missing", f"{n} IS NULL") for n in ("order_id", "customer_id", "product_id", "order_date")]
    + [
        ("quantity_missing", "quantity IS NULL"),
        ("quantity_not_positive", "quantity <= 0"),
        ("unit_price_missing", "unit_price IS NULL"),
        ("unit_price_negative", "unit_price < 0"),
    ]
)


@query(
    "dq_reason",
    f"""WITH {s.CAST_ORDERS} SELECT order_id, product_id, store_id, '{REASON}' AS dq_reason,
           {ORDER_RULES_SQL} AS failed_rules
    FROM cast_o WHERE coalesce({s.BAD_ORDER}, FALSE)""",
)
def reason(t):
    typed = clean.cast_orders(_raw_orders(t))
    rejected = quality.split_valid(typed, quality.order_rules())[1]
    return rejected.select(
        "order_id",
        "product_id",
        "store_id",
        "dq_reason",
        F.concat_ws(",", "failed_rules").alias("failed_rules"),
    )


@query(
    "dq_fk_check",
    f"""WITH {s.ORDERS}, known_c AS (SELECT CAST(c_custkey AS VARCHAR) AS k FROM customer
           WHERE c_acctbal >= 0), known_p AS (SELECT CAST(p_partkey AS VARCHAR) AS k FROM part
           WHERE p_size > 5)
    SELECT order_id, customer_id, product_id, store_id,
           CASE WHEN customer_id IN (SELECT k FROM known_c) AND product_id IN (SELECT k FROM known_p)
                THEN 'valid' ELSE '{quality.REFERENCE_REASON}' END AS outcome
    FROM r_orders""",
)
def fk_check(t):
    people = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"))
    goods = t.part.filter("p_size > 5").select(F.col("p_partkey").alias("product_id"))
    orders = bridge.order_lines(t).select("order_id", "customer_id", "product_id", "store_id")
    valid, rejected = quality.check_references(
        orders, {"customer_id": people, "product_id": goods}
    )
    return valid.withColumn("outcome", F.lit("valid")).unionByName(
        rejected.withColumnRenamed("dq_reason", "outcome").drop("failed_rules")
    )


@query(
    "dq_rule_suite",
    f"""WITH {s.ORDERS}, c AS (SELECT count(*) AS total_rows,
           count(order_id) - count(DISTINCT order_id) AS unique_order_id,
           count(*) FILTER (customer_id IS NULL) AS not_null_customer_id,
           count(*) FILTER (product_id IS NULL) AS not_null_product_id,
           count(*) FILTER (quantity IS NULL) AS not_null_quantity,
           count(*) FILTER (order_status NOT IN ('CANCELLED', 'SHIPPED', 'DELIVERED'))
             AS accepted_values_order_status,
           count(*) FILTER (quantity NOT BETWEEN 1 AND 10000) AS numeric_range_quantity,
           count(*) FILTER (unit_price NOT BETWEEN 0.01 AND 1000000) AS numeric_range_unit_price
      FROM r_orders)
    SELECT r.rule, r."column", r.failed_rows, total_rows FROM (SELECT total_rows, unnest([
      {{'rule': 'required', 'column': 'order_id', 'failed_rows': 0}},
      {{'rule': 'required', 'column': 'customer_id', 'failed_rows': 0}},
      {{'rule': 'required', 'column': 'product_id', 'failed_rows': 0}},
      {{'rule': 'required', 'column': 'quantity', 'failed_rows': 0}},
      {{'rule': 'required', 'column': 'unit_price', 'failed_rows': 0}},
      {{'rule': 'required', 'column': 'order_status', 'failed_rows': 0}},
      {{'rule': 'unique', 'column': 'order_id', 'failed_rows': unique_order_id}},
      {{'rule': 'not_null', 'column': 'customer_id', 'failed_rows': not_null_customer_id}},
      {{'rule': 'not_null', 'column': 'product_id', 'failed_rows': not_null_product_id}},
      {{'rule': 'not_null', 'column': 'quantity', 'failed_rows': not_null_quantity}},
      {{'rule': 'accepted_values', 'column': 'order_status',
        'failed_rows': accepted_values_order_status}},
      {{'rule': 'numeric_range', 'column': 'quantity', 'failed_rows': numeric_range_quantity}},
      {{'rule': 'numeric_range', 'column': 'unit_price', 'failed_rows': numeric_range_unit_price}}
      ]) AS r FROM c)""",
)
def rule_suite(t):
    return quality.order_rule_suite(bridge.order_lines(t))


@query(
    "dq_csv_inspect",
    """WITH d AS (SELECT CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS l_suppkey,
             CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS l_linestatus FROM lineitem),
    c AS (SELECT l_suppkey, l_linestatus, count(*) AS n FROM d GROUP BY ALL),
    f AS (SELECT CAST(sum(n) AS BIGINT) AS total_rows,
             CAST(sum(CASE WHEN l_suppkey IS NULL AND l_linestatus IS NULL THEN n ELSE 0 END)
               AS BIGINT) AS blank_rows,
             CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM c)
    SELECT total_rows, blank_rows, duplicate_rows, blank_rows + duplicate_rows AS dq_failures,
           least(total_rows, blank_rows + duplicate_rows) AS rejected_rows,
           total_rows - least(total_rows, blank_rows + duplicate_rows) AS valid_rows FROM f""",
)
def csv_inspect(t):
    """Two columns in which many rows are equal and many are blank."""
    kept = F.col("l_returnflag") != "R"
    rows = t.lineitem.select(
        F.when(kept, F.col("l_suppkey")).alias("l_suppkey"),
        F.when(kept, F.col("l_linestatus")).alias("l_linestatus"),
    )
    return quality.inspect_rows(rows)


@query(
    "dq_integrity",
    f"""WITH {s.ORDERS} SELECT 'duplicate_order_id' AS "check",
           count(order_id) - count(DISTINCT order_id) AS failed_rows FROM r_orders
    UNION ALL SELECT 'missing_order_id', count(*) FILTER (order_id IS NULL) FROM r_orders
    UNION ALL SELECT 'missing_customer_id', count(*) FILTER (customer_id IS NULL) FROM r_orders
    UNION ALL SELECT 'missing_product_id', count(*) FILTER (product_id IS NULL) FROM r_orders
    UNION ALL SELECT 'orphan_customer_id', count(*) FROM r_orders WHERE customer_id NOT IN
      (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal >= 0)
    UNION ALL SELECT 'orphan_product_id', count(*) FROM r_orders WHERE product_id NOT IN
      (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 5)""",
)
def integrity(t):
    people = t.customer.filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("string").alias("customer_id")
    )
    goods = t.part.filter("p_size > 5").select(
        F.col("p_partkey").cast("string").alias("product_id")
    )
    return quality.integrity_report(bridge.order_lines(t), people, goods)


@query(
    "dq_profile",
    f"""WITH {s.CAST_ORDERS}, c AS (SELECT count(*) AS n,
      [{', '.join(f"count(*) FILTER ({n} IS NULL)" for n in (
        'order_id', 'customer_id', 'product_id', 'order_date', 'quantity', 'unit_price',
        'payment_method', 'order_status', 'store_id'))}] AS nulls FROM cast_o)
    SELECT r."column", r.type, n AS row_count, r.null_count FROM (SELECT n, unnest([
      {{'column': 'order_id', 'type': 'bigint', 'null_count': nulls[1]}},
      {{'column': 'customer_id', 'type': 'bigint', 'null_count': nulls[2]}},
      {{'column': 'product_id', 'type': 'bigint', 'null_count': nulls[3]}},
      {{'column': 'order_date', 'type': 'date', 'null_count': nulls[4]}},
      {{'column': 'quantity', 'type': 'bigint', 'null_count': nulls[5]}},
      {{'column': 'unit_price', 'type': 'double', 'null_count': nulls[6]}},
      {{'column': 'payment_method', 'type': 'string', 'null_count': nulls[7]}},
      {{'column': 'order_status', 'type': 'string', 'null_count': nulls[8]}},
      {{'column': 'store_id', 'type': 'string', 'null_count': nulls[9]}}]) AS r FROM c)""",
)
def profile(t):
    return quality.profile(
        clean.cast_orders(bridge.raw_orders(t)).drop("operation", "arrived_on")
    )


@query(
    "dq_scd2_verify",
    """WITH v AS (SELECT user_id, ts, event_type = 'view' AS is_current FROM events),
    k AS (SELECT user_id, count(*) AS n, count(*) FILTER (is_current) AS cur,
            count(*) FILTER (CAST(ts AS DATE) > DATE '2024-01-20') AS rev FROM v GROUP BY user_id)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(cur) AS BIGINT) AS current_rows,
           CAST(sum(n - cur) AS BIGINT) AS historical_rows,
           count(*) FILTER (cur > 1) AS bad_current_keys, CAST(sum(rev) AS BIGINT) AS bad_date_order
    FROM k""",
)
def scd2_verify(t):
    """Events as versions of their user, so that both kinds of damage occur."""
    versions = t.events.select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("effective_from"),
        F.lit("2024-01-20").cast("date").alias("effective_to"),
        (F.col("event_type") == "view").alias("is_current"),
    )
    return quality.verify_history(versions)


@query(
    "dq_fact_verify",
    f"""WITH {s.FACT} SELECT count(*) AS total_rows,
           count(sale_id) - count(DISTINCT sale_id) AS duplicate_sale_ids FROM fact""",
)
def fact_verify(t):
    return quality.verify_fact(bridge.fact_sales(t).select(*FACT_COLUMNS))


@query(
    "dq_lookup_gate",
    """SELECT count(*) FILTER (p IS NULL) AS missing_product_key,
              count(*) FILTER (s IS NULL) AS missing_store_key
    FROM lineitem LEFT JOIN (SELECT p_partkey AS p FROM part WHERE p_size > 5) ON l_partkey = p
    LEFT JOIN (SELECT s_suppkey AS s FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s""",
)
def lookup_gate(t):
    goods = t.part.filter("p_size > 5").select(F.col("p_partkey").alias("product_key"))
    shops = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("store_key"))
    lines = t.lineitem.join(goods, F.col("l_partkey") == F.col("product_key"), "left").join(
        shops, F.col("l_suppkey") == F.col("store_key"), "left"
    )
    return quality.missing_keys(lines, ["product_key", "store_key"])


@query(
    "flt_cdc_delete",
    f"""WITH {s.RAW_ORDERS} SELECT order_id, product_id, store_id, operation FROM raw_o
    WHERE upper(trim(operation)) IN ('DELETE', 'D')""",
)
def cdc_delete(t):
    deletes = quality.split_deletes(bridge.raw_orders(t))[1]
    return deletes.select("order_id", "product_id", "store_id", "operation")


@query(
    "flt_date_range",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status
    FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-04-01'
      AND o_orderstatus IS NOT NULL""",
)
def date_range(t):
    """The filter compares the stored column, so the scan gets it."""
    orders = t.orders.select(
        "o_orderkey", F.col("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("order_status")
    )
    chosen = orders.where(
        quality.within_days("order_date", "1996-01-01", "1996-04-01") & quality.known_status()
    )
    return chosen.withColumn("order_date", F.col("order_date").cast("date"))


@query(
    "flt_current",
    """SELECT user_id AS customer_id, ts AS effective_from, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn
      FROM events) WHERE rn = 1""",
)
def current(t):
    """Without a current mark: the latest start per id."""
    return quality.current_versions(
        t.events.select(
            F.col("user_id").alias("customer_id"), F.col("ts").alias("effective_from"), "event_type"
        )
    )


NOW = datetime(2024, 1, 31)


@query(
    "flt_run_selection",
    f"""WITH {s.RUNS} SELECT run_id, job_name, processing_status, ingestion_time FROM runs
    WHERE processing_status IN ('FAILED', 'PARTIAL') AND job_name IN ('error', 'signup', 'view')
      AND ingestion_time >= TIMESTAMP '2024-01-24'""",
)
def run_selection(t):
    chosen = monitoring.select_runs(
        bridge.pipeline_runs(t), ["FAILED", "PARTIAL"], ["error", "signup", "view"], 7, NOW
    )
    return chosen.select("run_id", "job_name", "processing_status", "ingestion_time")


EVENTS_SQL = f"""{s.RUNS}, run_events AS (
      SELECT run_id, ingestion_time AS event_time,
             CASE WHEN processing_status = 'FAILED' THEN 'ERROR' WHEN rejected_count > 0
                  THEN 'WARNING' ELSE 'INFO' END AS severity, 'PIPELINE_RUN' AS event_type,
             job_name || ': ' || processing_status || '; records=' || record_count
               || '; rejected=' || rejected_count AS message FROM runs
      UNION ALL SELECT run_id, ingestion_time, 'ERROR', 'PIPELINE_ERROR',
             substr(error_message, 1, 2000) FROM runs WHERE error_message <> ''
      UNION ALL SELECT run_id, ingestion_time, 'WARNING', 'DATA_QUALITY',
             data_quality_failures || ' data-quality failure(s) recorded.' FROM runs
             WHERE data_quality_failures > 0)"""


@query(
    "flt_event_severity",
    f"WITH {EVENTS_SQL} SELECT * FROM run_events WHERE severity IN ('ERROR', 'WARNING')",
)
def event_severity(t):
    events = monitoring.derive_events(bridge.pipeline_runs(t))
    return monitoring.select_events(events, ["ERROR", "WARNING"])


# --- monitoring -----------------------------------------------------------------------


@query(
    "ag_kpi_runs",
    f"""WITH {s.RUNS} SELECT count(*) AS pipeline_runs,
           CAST(count(*) FILTER (processing_status = 'SUCCESS') AS DOUBLE) / count(*) * 100.0
             AS success_rate,
           count(*) FILTER (processing_status = 'FAILED') AS failed_runs,
           CAST(sum(record_count) AS BIGINT) AS total_records,
           CAST(sum(rejected_count) AS BIGINT) AS rejected_records,
           CAST(sum(CAST(processing_time AS DECIMAL(18,3))) AS DOUBLE) / count(processing_time)
             AS avg_duration FROM runs""",
)
def kpis(t):
    from tillwright.operators.aggregates import run_kpis

    return run_kpis(bridge.pipeline_runs(t))


@query(
    "ag_runs_daily",
    f"""WITH {s.RUNS} SELECT CAST(ingestion_time AS DATE) AS run_date, processing_status,
           count(*) AS runs FROM runs GROUP BY ALL""",
)
def runs_daily(t):
    from tillwright.operators.aggregates import runs_daily as daily

    return daily(bridge.pipeline_runs(t))


@query(
    "so_latest_runs",
    f"""WITH {s.RUNS} SELECT run_id, ingestion_time, job_name, file_name, record_count, valid_count,
           rejected_count, processing_status FROM runs
    ORDER BY ingestion_time DESC, run_id DESC LIMIT 25""",
)
def latest_runs(t):
    from tillwright.operators.ordering import latest_runs as latest

    return latest(bridge.pipeline_runs(t)).select(
        "run_id", "ingestion_time", "job_name", "file_name", "record_count", "valid_count",
        "rejected_count", "processing_status",
    )


@query("monitoring_events", f"WITH {EVENTS_SQL} SELECT * FROM run_events")
def all_events(t):
    return monitoring.derive_events(bridge.pipeline_runs(t))


@query(
    "monitoring_lineage",
    f"""WITH {s.RUNS} SELECT run_id, file_name, source, ingestion_time, record_count,
           processing_status, processing_time, CAST(error_count AS BIGINT) AS error_count, job_name,
           error_message FROM runs""",
)
def lineage(t):
    return monitoring.lineage(bridge.pipeline_runs(t))
