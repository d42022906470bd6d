"""SQL text shared by the checks: the retail model written a second time, in SQL."""

PLACES = "nation JOIN region ON n_regionkey = r_regionkey"

CUSTOMERS = f"""r_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
         lower(replace(c_name, '#', '')) || '@example.com' AS email,
         n_name AS city, r_name AS state, first_day AS signup_date,
         c_mktsegment AS customer_segment, c_acctbal AS balance
  FROM customer JOIN ({PLACES}) ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day
             FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""

PRODUCTS = """r_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_type AS category, p_retailprice AS price, p_brand AS supplier FROM part)"""

ORDERS = """r_orders AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice / l_quantity AS unit_price, o_orderpriority AS payment_method,
         o_orderstatus AS order_status, CAST(l_suppkey AS VARCHAR) AS store_id,
         l_discount AS discount, CAST(l_shipdate AS DATE) AS arrived_on
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FACT = """fact AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS sale_id, o_custkey AS customer_key,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)
           AS date_key,
         l_partkey AS product_key, l_suppkey AS store_key, CAST(l_quantity AS BIGINT) AS quantity,
         l_quantity * (l_extendedprice / l_quantity) AS sales_amount, l_discount AS discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DIM_DATE = """d_date AS (
  SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(o_orderdate AS DATE) AS full_date FROM orders)"""

DIM_PRODUCT = """d_product AS (
  SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id,
         p_name AS product_name, p_type AS category, p_retailprice AS price,
         p_brand AS supplier FROM part)"""

DIM_CUSTOMER = f"""{CUSTOMERS}, d_customer AS (
  SELECT CAST(customer_id AS BIGINT) AS customer_key, customer_id, customer_name, email, city,
         state, signup_date, customer_segment, DATE '1995-01-01' AS effective_from,
         DATE '9999-12-31' AS effective_to, TRUE AS is_current, 1 AS version FROM r_customers)"""

# Raw text with faults, then the same rows cast. The casts avoid TRY_CAST to whole
# numbers, which rounds where a text with decimals has to become null.
RAW_CUSTOMERS = f"""raw_c AS (
  SELECT CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'x' || c_custkey
              ELSE ' ' || c_custkey || ' ' END AS customer_id,
         '  ' || upper(c_name) || ' ' AS customer_name,
         CASE WHEN c_acctbal < 0 AND c_mktsegment = 'MACHINERY' THEN NULL
              WHEN c_acctbal < 0 AND c_mktsegment = 'FURNITURE' THEN 'no-at-sign'
              ELSE '  ' || replace(c_name, '#', '') || '@Example.COM ' END AS email,
         n_name || ' ' AS city, lower(r_name) AS state,
         CASE WHEN c_acctbal < 0 AND c_mktsegment = 'HOUSEHOLD' THEN 'not a date'
              ELSE CAST(year(first_day) AS VARCHAR) || '-' || month(first_day) || '-'
                   || day(first_day) END AS signup_date,
         lower(c_mktsegment) AS customer_segment
  FROM customer JOIN ({PLACES}) ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_day FROM orders GROUP BY o_custkey)
    ON c_custkey = o_custkey)"""

CAST_CUSTOMERS = f"""{RAW_CUSTOMERS}, cast_c AS (
  SELECT CASE WHEN regexp_full_match(trim(customer_id), '[+-]?[0-9]+')
              THEN CAST(trim(customer_id) AS BIGINT) END AS customer_id,
         trim(customer_name) AS customer_name, lower(trim(email)) AS email, trim(city) AS city,
         upper(trim(state)) AS state,
         CAST(try_strptime(trim(signup_date), '%Y-%m-%d') AS DATE) AS signup_date,
         upper(trim(customer_segment)) AS customer_segment FROM raw_c)"""

BAD_CUSTOMER = (
    "(customer_id IS NULL OR email IS NULL OR NOT regexp_full_match(email, "
    "'[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))"
)

RAW_PRODUCTS = """raw_p AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE p_size WHEN 1 THEN '   ' WHEN 2 THEN NULL ELSE ' ' || p_name END AS product_name,
         lower(p_type) || ' ' AS category,
         CASE p_size WHEN 3 THEN '-' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)
                     WHEN 4 THEN 'n/a'
                     ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
         ' ' || p_brand AS supplier FROM part)"""

CAST_PRODUCTS = f"""{RAW_PRODUCTS}, cast_p AS (
  SELECT CAST(product_id AS BIGINT) AS product_id, trim(product_name) AS product_name,
         upper(trim(category)) AS category, TRY_CAST(price AS DOUBLE) AS price,
         trim(supplier) AS supplier FROM raw_p)"""

BAD_PRODUCT = (
    "(product_id IS NULL OR product_name IS NULL OR product_name = '' "
    "OR price IS NULL OR price < 0)"
)

RAW_ORDERS = """raw_o AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS order_id,
         CASE WHEN NOT (l_returnflag = 'R' AND l_tax = 0.03) THEN CAST(o_custkey AS VARCHAR) END
           AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_returnflag = 'R' AND l_tax = 0.04 THEN 'soon'
              WHEN l_linestatus = 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || '-'
                   || month(o_orderdate) || '-' || day(o_orderdate)
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN l_returnflag = 'R' AND l_tax = 0.08 THEN 'many'
              WHEN l_returnflag = 'R' AND l_tax = 0.07 THEN '0'
              WHEN l_returnflag = 'R' AND l_tax = 0.06
                THEN '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
              WHEN l_returnflag = 'R' AND l_tax = 0.02 THEN '12.7'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
         CASE WHEN l_returnflag = 'R' AND l_tax = 0.05 THEN '-1.5'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
         lower(o_orderpriority) AS payment_method, lower(o_orderstatus) AS order_status,
         ' ' || l_suppkey AS store_id,
         CASE WHEN l_returnflag = 'A' AND l_tax = 0.08 THEN ' delete '
              WHEN l_returnflag = 'A' AND l_tax = 0.07 THEN 'd' ELSE 'UPSERT' END AS operation,
         strftime(l_shipdate, '%Y-%m-%d') AS arrived_on
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CAST_ORDERS = f"""{RAW_ORDERS}, cast_o AS (
  SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
         CAST(product_id AS BIGINT) AS product_id,
         CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
         CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') THEN CAST(quantity AS BIGINT) END
           AS quantity,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price, upper(payment_method) AS payment_method,
         upper(order_status) AS order_status, trim(store_id) AS store_id, operation, arrived_on
  FROM raw_o)"""

BAD_ORDER = (
    "(order_id IS NULL OR customer_id IS NULL OR product_id IS NULL OR order_date IS NULL "
    "OR quantity IS NULL OR quantity <= 0 OR unit_price IS NULL OR unit_price < 0)"
)

RUNS = """runs AS (
  SELECT *, record_count - rejected_count AS valid_count,
         CASE WHEN processing_status = 'FAILED' THEN 1 ELSE 0 END AS error_count,
         CASE WHEN processing_status = 'PARTIAL' THEN rejected_count ELSE 0 END
           AS data_quality_failures,
         CASE WHEN processing_status = 'FAILED' THEN 'failed: ' || source END AS error_message
  FROM (SELECT event_id AS run_id, 'user_' || user_id || '.csv' AS file_name, props AS source,
               ts AS ingestion_time, CAST(floor(value * 100) AS BIGINT) AS record_count,
               CASE WHEN event_type IN ('error', 'signup') THEN CAST(floor(value) AS BIGINT)
                    ELSE 0 END AS rejected_count,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PARTIAL'
                    ELSE 'SUCCESS' END AS processing_status,
               value AS processing_time, event_type AS job_name FROM events))"""


def money(expression: str) -> str:
    return f"round(sum(CAST({expression} AS DOUBLE)), 2)"


def round2(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), 2) AS DOUBLE)"

HISTORY = f"""{CUSTOMERS}, history AS (
  SELECT CAST(customer_id AS BIGINT) * 10 + 1 AS customer_key, customer_id, customer_name, email,
         city, state, signup_date, customer_segment,
         CASE WHEN balance < 0 THEN DATE '1996-01-01' ELSE DATE '1995-01-01' END AS effective_from,
         CASE WHEN balance > 5000 THEN DATE '1997-12-31' ELSE DATE '9999-12-31' END
           AS effective_to,
         balance <= 5000 AS is_current, 1 AS version FROM r_customers
  UNION ALL
  SELECT CAST(customer_id AS BIGINT) * 10 + 2, customer_id, customer_name, email, city, state,
         signup_date, 'PREMIUM', DATE '1998-01-01', DATE '9999-12-31', TRUE, 2
  FROM r_customers WHERE balance > 5000)"""

# One row per order number: last arrival, then the greatest content.
LAST_ORDERS = f"""{ORDERS}, last_orders AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY arrived_on DESC NULLS LAST, customer_id DESC, product_id DESC, store_id DESC,
      order_date DESC, quantity DESC, unit_price DESC, discount DESC) AS rn FROM r_orders)
  WHERE rn = 1)"""

# The star as the jobs build it: generated keys over products, stores and history.
STAR = f"""{LAST_ORDERS}, {HISTORY}, {PRODUCTS},
star_product AS (SELECT row_number() OVER (ORDER BY product_id) AS product_key, * FROM r_products),
star_store AS (SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id
  FROM (SELECT DISTINCT store_id FROM r_orders)),
star_fact AS (
  SELECT order_id AS sale_id, h.customer_key, p.product_key, s.store_key,
         CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, quantity,
         quantity * unit_price AS sales_amount, discount
  FROM last_orders o
  JOIN history h ON o.customer_id = h.customer_id
    AND order_date BETWEEN h.effective_from AND h.effective_to
  JOIN star_product p ON o.product_id = p.product_id
  JOIN star_store s ON o.store_id = s.store_id)"""
