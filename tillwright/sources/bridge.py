"""The given tables in the shape of the retail model.

Typed tables for queries, star views for reports, and text tables with faults
for the cleaning jobs. The faults are rules on ordinary attributes (balance,
tax, size), so every table is used whole and at any scale.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.dates import calendar_columns, day_key
from tillwright.functions.money import line_amount

OPEN_END = "9999-12-31"


# The given tables do not change, so a session looks up each schema once.
_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


class Tables:
    """The given Parquet tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            path = f"{self.folder}/{name}.parquet"
            seen = (self.spark.sparkContext.applicationId, path)
            if seen in _SCHEMAS:
                self._read[name] = self.spark.read.schema(_SCHEMAS[seen]).parquet(path)
            else:
                self._read[name] = self.spark.read.parquet(path)
                _SCHEMAS[seen] = self._read[name].schema
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def places(self) -> DataFrame:
        return self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )


# --- typed retail tables ------------------------------------------------------


def customers(t: Tables, signup: bool = True) -> DataFrame:
    base = t.customer.join(t.places, F.col("c_nationkey") == F.col("n_nationkey"))
    columns = [
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit(""))), F.lit("@example.com")).alias(
            "email"
        ),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
    ]
    if signup:
        first = t.orders.groupBy("o_custkey").agg(
            F.min(F.col("o_orderdate").cast("date")).alias("first_day")
        )
        base = base.join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
        columns.append(F.col("first_day").alias("signup_date"))
    return base.select(
        *columns, F.col("c_mktsegment").alias("customer_segment"), F.col("c_acctbal").alias("balance")
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("supplier"),
    )


def stores(t: Tables) -> DataFrame:
    return t.supplier.join(t.places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("store_id"), F.col("r_name").alias("region")
    )


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _order_number() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _unit_price() -> Column:
    return F.try_divide("l_extendedprice", "l_quantity")


#: The key of the given order, beside its lines.
ORDER_KEY = "order_key"


def one_key_per_number(t: Tables) -> bool:
    """Whether lines with the same order number belong to the same given order.

    The number is ten times the key plus the line, so it tells the key if each line is a
    digit. One scan of the line numbers that ends with the first that is none.
    """
    digit = F.coalesce(F.col("l_linenumber").between(0, 9), F.lit(False))
    return t.lineitem.filter(~digit).isEmpty()


def order_lines(t: Tables, keyed: bool = False) -> DataFrame:
    """One retail order per order line; order numbers repeat in the given data.

    ``keyed`` adds ``ORDER_KEY``, by which the join of lines and orders deals them out.
    """
    key = [F.col("l_orderkey").alias(ORDER_KEY)] if keyed else []
    return _lines(t).select(
        *key,
        _order_number().cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _unit_price().alias("unit_price"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("l_discount").alias("discount"),
        F.col("l_shipdate").cast("date").alias("arrived_on"),
    )


# --- star views: the given keys serve as surrogate keys -----------------------


def fact_sales(t: Tables, with_order: bool = True) -> DataFrame:
    """Sales fact; without order columns it needs no join at all."""
    lines = _lines(t) if with_order else t.lineitem
    order_columns = (
        [F.col("o_custkey").alias("customer_key"), day_key("o_orderdate").alias("date_key")]
        if with_order
        else []
    )
    return lines.select(
        _order_number().cast("string").alias("sale_id"),
        *order_columns,
        F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("store_key"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        line_amount(F.col("l_quantity"), _unit_price()).alias("sales_amount"),
        F.col("l_discount").alias("discount"),
    )


def dim_customer(t: Tables) -> DataFrame:
    """One open version per customer, valid from before the first order."""
    people = customers(t)
    return people.select(
        F.col("customer_id").cast("bigint").alias("customer_key"),
        "customer_id",
        "customer_name",
        "email",
        "city",
        "state",
        "signup_date",
        "customer_segment",
        F.lit("1995-01-01").cast("date").alias("effective_from"),
        F.lit(OPEN_END).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"),
    )


def dim_product(t: Tables) -> DataFrame:
    return products(t).select(F.col("product_id").cast("bigint").alias("product_key"), "*")


def dim_store(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("store_key"), F.col("s_suppkey").cast("string").alias("store_id")
    )


def dim_date(t: Tables) -> DataFrame:
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.filter(F.col("d").isNotNull()).select(*calendar_columns("d"))


# --- raw text tables with faults ----------------------------------------------


def _unpadded(day: Column) -> Column:
    return F.when(
        day.isNotNull(), F.concat_ws("-", F.year(day), F.month(day), F.dayofmonth(day))
    )


def raw_customers(t: Tables) -> DataFrame:
    """Indebted customers carry one fault each, chosen by their segment."""
    segment = F.col("c_mktsegment")
    debt = F.col("c_acctbal") < 0
    base = t.customer.join(t.places, F.col("c_nationkey") == F.col("n_nationkey"))
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"))
    base = base.join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    good_mail = F.concat(
        F.lit("  "), F.replace("c_name", F.lit("#"), F.lit("")), F.lit("@Example.COM ")
    )
    return base.select(
        F.when(debt & (segment == "BUILDING"), F.concat(F.lit("x"), F.col("c_custkey")))
        .otherwise(F.concat(F.lit(" "), F.col("c_custkey"), F.lit(" ")))
        .alias("customer_id"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("customer_name"),
        F.when(debt & (segment == "MACHINERY"), F.lit(None).cast("string"))
        .when(debt & (segment == "FURNITURE"), F.lit("no-at-sign"))
        .otherwise(good_mail)
        .alias("email"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("city"),
        F.lower("r_name").alias("state"),
        F.when(debt & (segment == "HOUSEHOLD"), F.lit("not a date"))
        .otherwise(_unpadded(F.col("first_day")))
        .alias("signup_date"),
        F.lower(segment).alias("customer_segment"),
    )


def raw_products(t: Tables) -> DataFrame:
    """The smallest sizes carry faults in name and price."""
    size = F.col("p_size")
    price = F.col("p_retailprice").cast("decimal(18,2)").cast("string")
    return t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(size == 1, F.lit("   "))
        .when(size == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.col("p_name")))
        .alias("product_name"),
        F.concat(F.lower("p_type"), F.lit(" ")).alias("category"),
        F.when(size == 3, F.concat(F.lit("-"), price))
        .when(size == 4, F.lit("n/a"))
        .otherwise(price)
        .alias("price"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("supplier"),
    )


def raw_orders(t: Tables) -> DataFrame:
    """Returned lines carry a fault for some tax rates; some lines are delete records."""
    returned = F.col("l_returnflag") == "R"
    tax = F.col("l_tax")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    day = F.col("o_orderdate").cast("date")
    return _lines(t).select(
        _order_number().cast("string").alias("order_id"),
        F.when(~(returned & (tax == 0.03)), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(returned & (tax == 0.04), F.lit("soon"))
        .when(F.col("l_linestatus") == "O", _unpadded(day))
        .otherwise(day.cast("string"))
        .alias("order_date"),
        F.when(returned & (tax == 0.08), F.lit("many"))
        .when(returned & (tax == 0.07), F.lit("0"))
        .when(returned & (tax == 0.06), F.concat(F.lit("-"), quantity))
        .when(returned & (tax == 0.02), F.lit("12.7"))
        .otherwise(quantity)
        .alias("quantity"),
        F.when(returned & (tax == 0.05), F.lit("-1.5")).otherwise(price).alias("unit_price"),
        F.lower("o_orderpriority").alias("payment_method"),
        F.lower("o_orderstatus").alias("order_status"),
        F.concat(F.lit(" "), F.col("l_suppkey")).alias("store_id"),
        F.when((F.col("l_returnflag") == "A") & (tax == 0.08), F.lit(" delete "))
        .when((F.col("l_returnflag") == "A") & (tax == 0.07), F.lit("d"))
        .otherwise(F.lit("UPSERT"))
        .alias("operation"),
        F.col("l_shipdate").cast("date").cast("string").alias("arrived_on"),
    )


# --- event-based tables -------------------------------------------------------


def pipeline_runs(t: Tables) -> DataFrame:
    """Every event as one pipeline run: its type is the job, its value the duration."""
    status = (
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "signup", "PARTIAL")
        .otherwise("SUCCESS")
    )
    records = F.floor(F.col("value") * 100).cast("bigint")
    rejected = F.when(status == "SUCCESS", F.lit(0)).otherwise(F.floor("value")).cast("bigint")
    return t.events.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("user_"), F.col("user_id"), F.lit(".csv")).alias("file_name"),
        F.col("props").alias("source"),
        F.col("ts").alias("ingestion_time"),
        records.alias("record_count"),
        (records - rejected).alias("valid_count"),
        rejected.alias("rejected_count"),
        status.alias("processing_status"),
        F.col("value").alias("processing_time"),
        F.when(status == "FAILED", 1).otherwise(0).cast("bigint").alias("error_count"),
        F.when(status == "PARTIAL", rejected)
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("data_quality_failures"),
        F.col("event_type").alias("job_name"),
        F.when(status == "FAILED", F.concat(F.lit("failed: "), F.col("props"))).alias(
            "error_message"
        ),
    )


def user_changes(t: Tables) -> DataFrame:
    """Events as change records of one row per user."""
    return t.events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("updated_at"),
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("operation"),
        "event_type",
        "value",
    )


def customer_history(t: Tables) -> DataFrame:
    """Customer versions: wealthy customers changed segment in 1998, indebted ones
    are known from 1996 only."""
    people = customers(t)
    first = F.when(F.col("balance") < 0, F.lit("1996-01-01")).otherwise(F.lit("1995-01-01"))
    moved = F.col("balance") > 5000
    opened = F.struct(
        first.cast("date").alias("effective_from"),
        F.when(moved, F.lit("1997-12-31")).otherwise(F.lit(OPEN_END)).cast("date").alias(
            "effective_to"
        ),
        (~moved).alias("is_current"),
        F.lit(1).alias("version"),
        F.col("customer_segment").alias("segment"),
    )
    second = F.struct(
        F.lit("1998-01-01").cast("date").alias("effective_from"),
        F.lit(OPEN_END).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(2).alias("version"),
        F.lit("PREMIUM").alias("segment"),
    )
    versions = people.withColumn(
        "v", F.explode(F.when(moved, F.array(opened, second)).otherwise(F.array(opened)))
    )
    return versions.select(
        (F.col("customer_id").cast("bigint") * 10 + F.col("v.version")).alias("customer_key"),
        "customer_id",
        "customer_name",
        "email",
        "city",
        "state",
        "signup_date",
        F.col("v.segment").alias("customer_segment"),
        "v.effective_from",
        "v.effective_to",
        "v.is_current",
        "v.version",
    )


def snapshot(t: Tables, number: int) -> DataFrame:
    """Customer source as three successive extracts saw it.

    The first lacks indebted customers, from the second on wealthy customers are
    premium, in the third the wealthiest have moved.
    """
    people = customers(t)
    if number == 1:
        return people.filter("balance >= 0").drop("balance")
    segment = F.when(F.col("balance") > 9000, "PREMIUM").otherwise(F.col("customer_segment"))
    people = people.withColumn("customer_segment", segment)
    if number == 3:
        city = F.when(F.col("balance") > 9500, "ELSEWHERE").otherwise(F.col("city"))
        people = people.withColumn("city", city)
    return people.drop("balance")
