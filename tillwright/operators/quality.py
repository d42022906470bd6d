"""Row rules, quarantine split, reference checks and data-quality reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillwright.functions.text import EMAIL_PATTERN, code
from tillwright.schemas import (
    CHANGE_COLUMNS,
    DELETE_MARKS,
    FACT_COLUMNS,
    SchemaError,
    require_columns,
)

# Reasons written next to rejected rows.
RULE_REASON = "Schema or business validation failed"
REFERENCE_REASON = "Customer ID or Product ID does not exist"

Rules = dict[str, Column]


class QualityError(ValueError):
    """Data that must not be loaded."""


# --- row rules: name -> condition that is true for a bad row ------------------


def customer_rules() -> Rules:
    return {
        "customer_id_missing": F.col("customer_id").isNull(),
        "email_missing": F.col("email").isNull(),
        "email_malformed": ~F.col("email").rlike(EMAIL_PATTERN),
    }


def product_rules() -> Rules:
    return {
        "product_id_missing": F.col("product_id").isNull(),
        "product_name_missing": F.col("product_name").isNull(),
        "product_name_empty": F.col("product_name") == "",
        "price_missing": F.col("price").isNull(),
        "price_negative": F.col("price") < 0,
    }


def _quantity_rules() -> Rules:
    return {
        "quantity_missing": F.col("quantity").isNull(),
        "quantity_not_positive": F.col("quantity") <= 0,
    }


def _unit_price_rules() -> Rules:
    return {
        "unit_price_missing": F.col("unit_price").isNull(),
        "unit_price_negative": F.col("unit_price") < 0,
    }


def order_rules() -> Rules:
    ids = ("order_id", "customer_id", "product_id", "order_date")
    missing = {f"{n}_missing": F.col(n).isNull() for n in ids}
    return missing | _quantity_rules() | _unit_price_rules()


def enriched_rules(columns: list[str]) -> Rules:
    rules: Rules = {"order_id_missing": F.col("order_id").isNull()}
    if "quantity" in columns:
        rules |= _quantity_rules()
    if "unit_price" in columns:
        rules |= _unit_price_rules()
    return rules


def failed_rules(rules: Rules) -> Column:
    """Array of the names of the rules a row breaks; a null condition is no breach."""
    marks = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]
    return F.array_compact(F.array(*marks))


def any_failed(rules: Rules) -> Column:
    checks = [F.coalesce(bad, F.lit(False)) for bad in rules.values()]
    return reduce(lambda a, b: a | b, checks)


def evaluated(df: DataFrame) -> DataFrame:
    """The same rows, every column computed once, whatever reads it afterwards.

    A rule refers to typed columns. Without this step the optimiser writes their casts out
    again in each rule and in a filter below the projection; it can't look into the struct
    that the generator takes apart. Columns that nobody needs should be dropped before.
    """
    row = F.struct(*[F.col(f"`{n}`") for n in df.columns])
    return df.select(F.inline(F.array(row)))


#: Groups that rows with a null key are dealt over in a reference check.
NULL_SPREAD = 1024
_SPREAD = "__null_spread"

#: What became of a row.
VALID, REJECTED, DELETED = "valid", "rejected", "deleted"


def split_valid(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows; the two are disjoint and together are the input."""
    bad, typed = any_failed(rules), evaluated(df)
    rejected = typed.filter(bad).withColumns(
        {"dq_reason": F.lit(RULE_REASON), "failed_rules": failed_rules(rules)}
    )
    return typed.filter(~bad), rejected


@dataclass(frozen=True)
class Outcomes:
    """A batch split in one pass: its rows by outcome, and how many there are of each."""

    valid: DataFrame
    rejected: DataFrame
    deletes: DataFrame
    counts: dict[str, int]


def write_outcomes(classified: DataFrame, path: str, deleted: str | None = None) -> Outcomes:
    """One write of a classified batch, in a folder per outcome, counted while it is written.

    ``deleted`` names a column that marks delete records; those are neither valid nor
    rejected. Every outcome is then read from its own folder only.
    """
    gone = F.col(deleted) if deleted else F.lit(False)
    outcome = F.when(gone, DELETED).when(F.col("dq_reason").isNull(), VALID).otherwise(REJECTED)
    seen = Observation()
    every = {n: F.count_if(F.col("outcome") == n).alias(n) for n in (VALID, REJECTED, DELETED)}
    marked = classified.withColumn("outcome", outcome).drop(*([deleted] if deleted else []))
    marked.observe(seen, *every.values()).write.partitionBy("outcome").parquet(path)
    schema = marked.drop("outcome").schema
    spark = classified.sparkSession

    def rows(name: str) -> DataFrame:
        if not seen.get[name]:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{path}/outcome={name}")

    reasons = ("dq_reason", "failed_rules")
    return Outcomes(
        rows(VALID).drop(*reasons),
        rows(REJECTED),
        rows(DELETED).drop(*reasons),
        {n: int(seen.get[n]) for n in every},
    )


def check_references(
    df: DataFrame, references: dict[str, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Split rows by whether every key column occurs in its reference table.

    ``references`` maps a key column to a frame that has a column of that name.
    """
    return split_classified(classify(df, {}, references))


def classify(
    df: DataFrame, rules: Rules, references: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Each row with the names of what it breaks and the reason, null for a good row.

    References are checked for rows that pass the rules. A null key is in no reference;
    rows without a key do not meet in one task.
    """
    df = evaluated(df)
    columns = df.columns
    if not references:
        marked = df.withColumn("failed_rules", failed_rules(rules))
        return marked.withColumn(
            "dq_reason", F.when(F.size("failed_rules") > 0, F.lit(RULE_REASON))
        )
    marked = df
    for key, table in references.items():
        same_type = F.col(key).try_cast(df.schema[key].dataType)
        known = table.select(same_type.alias(key)).filter(F.col(key).isNotNull()).distinct()
        # Rows without the key match nothing; a second join column spreads them. It is 0
        # for all others, on the reference's side by an expression that is not folded.
        known = known.withColumns(
            {_SPREAD: F.pmod(F.xxhash64(key), F.lit(1)), f"__known_{key}": F.lit(True)}
        )
        spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*columns), F.lit(NULL_SPREAD)))
        marked = marked.withColumn(_SPREAD, F.coalesce(spread, F.lit(0)).cast("bigint"))
        marked = marked.join(known, [key, _SPREAD], "left").drop(_SPREAD)
    lost = {f"{k}_unknown": F.col(f"__known_{k}").isNull() for k in references}
    marked = marked.select(
        *columns,
        (failed_rules(rules) if rules else F.array().cast("array<string>")).alias("__broken"),
        failed_rules(lost).alias("__lost"),
    )
    broken = F.size("__broken") > 0
    return marked.select(
        *columns,
        F.when(broken, F.col("__broken")).otherwise(F.col("__lost")).alias("failed_rules"),
        F.when(broken, F.lit(RULE_REASON))
        .when(F.size("__lost") > 0, F.lit(REFERENCE_REASON))
        .alias("dq_reason"),
    )


def split_classified(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows of a classified frame."""
    good = F.col("dq_reason").isNull()
    return df.filter(good).drop("dq_reason", "failed_rules"), df.filter(~good)


# --- change records -----------------------------------------------------------


def change_column(df: DataFrame) -> str | None:
    return next((n for n in CHANGE_COLUMNS if n in df.columns), None)


def is_delete(df: DataFrame) -> Column:
    name = change_column(df)
    if name is None:
        return F.lit(False)
    return F.coalesce(code(name).isin(*DELETE_MARKS), F.lit(False))


def split_deletes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to load, delete records)."""
    gone = is_delete(df)
    return df.filter(~gone), df.filter(gone)


# --- reports ------------------------------------------------------------------


def rule_suite(
    df: DataFrame,
    required_columns: list[str] | None = None,
    unique_key: str | None = None,
    not_null_columns: list[str] | None = None,
    accepted_values: dict[str, list[str]] | None = None,
    numeric_ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """(rule, column, failed_rows, total_rows).

    A missing required column counts every row. Nulls are the business of the
    not-null rule only; numeric ranges include both ends.

    All row counters come from one pass that shuffles one row per task. The
    unique key is counted apart, so that its shuffle carries the key only.
    """
    checks: list[tuple[str, str, Column]] = []
    for name in required_columns or []:
        missing = F.count(F.lit(1)) if name not in df.columns else F.lit(0).cast("bigint")
        checks.append(("required", name, missing))
    for name in not_null_columns or []:
        checks.append(("not_null", name, F.count_if(F.col(name).isNull())))
    for name, allowed in (accepted_values or {}).items():
        checks.append(("accepted_values", name, F.count_if(~F.col(name).isin(*allowed))))
    for name, (low, high) in (numeric_ranges or {}).items():
        number = F.col(name).try_cast("double")
        outside = F.col(name).isNotNull() & ~F.coalesce(number.between(low, high), F.lit(False))
        checks.append(("numeric_range", name, F.count_if(outside)))
    parts = [_report(df, checks)] if checks else []
    if unique_key:
        key = F.col(unique_key)
        repeated = F.count(key) - F.count_distinct(key)
        parts.append(_report(df, [("unique", unique_key, repeated)]))
    if not parts:
        raise QualityError("no check was asked for")
    return reduce(lambda a, b: a.unionByName(b), parts)


def _report(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate per check, turned into one row per check."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[c.cast("bigint").alias(f"c{i}") for i, (_, _, c) in enumerate(checks)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(name).alias("column"),
                F.col(f"c{i}").alias("failed_rows"),
            )
            for i, (rule, name, _) in enumerate(checks)
        ]
    )
    return counted.select(F.explode(rows).alias("r"), "total_rows").select("r.*", "total_rows")


def order_rule_suite(orders: DataFrame) -> DataFrame:
    """The rule set for orders; it reports and never rejects."""
    return rule_suite(
        orders,
        required_columns=[
            "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_status",
        ],
        unique_key="order_id",
        not_null_columns=["customer_id", "product_id", "quantity"],
        # The states and ranges of the order rules.
        accepted_values={"order_status": ["CANCELLED", "SHIPPED", "DELIVERED"]},
        numeric_ranges={"quantity": (1, 10000), "unit_price": (0.01, 1000000)},
    )


def inspect_rows(df: DataFrame) -> DataFrame:
    """Total, blank and repeated rows of an unknown source, in one row.

    Equal rows are counted map-side before the shuffle, so a group of copies of
    any size reaches the reducer as one row per task.
    """
    blank = reduce(lambda a, b: a & b, [F.col(f"`{n}`").isNull() for n in df.columns])
    copies = df.groupBy(*[F.col(f"`{n}`") for n in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    counted = copies.agg(
        total.alias("total_rows"),
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("blank_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    failures = F.col("blank_rows") + F.col("duplicate_rows")
    return counted.select(
        "total_rows",
        "blank_rows",
        "duplicate_rows",
        failures.alias("dq_failures"),
        F.least("total_rows", failures).alias("rejected_rows"),
        (F.col("total_rows") - F.least("total_rows", failures)).alias("valid_rows"),
    )


def integrity_report(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orphan ids, repeated order ids and missing names or ids: (check, failed_rows).

    The orders are read once: each row becomes one entry per id or name that is checked, and
    the entries are counted by kind and value, which combines in every task before the one
    shuffle. Of names only the lack is of interest, so all others are one value. The counted
    ids then meet the references, where no id is hot any more.
    """
    references = {"customer_id": customers, "product_id": products}
    ids = ["order_id", *references]
    names = [n for n in ("customer_name", "product_name") if n in orders.columns]
    present = [
        *[(n, F.col(n).cast("string")) for n in ids],
        *[(n, F.when(F.col(n).isNotNull(), F.lit(""))) for n in names],
    ]
    entries = F.array(*[F.struct(F.lit(n).alias("kind"), value.alias("value")) for n, value in present])
    counted = orders.select(F.inline(entries)).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for name, table in references.items():
        own = table.select(F.lit(name).alias("kind"), F.col(name).cast("string").alias("value"))
        known = own if known is None else known.unionByName(own)
    known = known.filter("value IS NOT NULL").distinct().withColumn("known", F.lit(True))
    met = counted.join(known, ["kind", "value"], "left")
    missing = F.col("value").isNull()

    def rows_where(condition: Column, n: Column | str = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(n) if isinstance(n, str) else n)), F.lit(0))

    checks = {f"missing_{n}": rows_where((F.col("kind") == n) & missing) for n, _ in present}
    checks["duplicate_order_id"] = rows_where((F.col("kind") == "order_id") & ~missing, F.col("n") - 1)
    for name in references:
        lost = (F.col("kind") == name) & ~missing & F.col("known").isNull()
        checks[f"orphan_{name}"] = rows_where(lost)
    found = met.agg(*[c.alias(n) for n, c in checks.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failed_rows")) for n in checks])
    return found.select(F.inline(pairs))


def profile(df: DataFrame) -> DataFrame:
    """(column, type, row_count, null_count) for every column, one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"n{i}") for i, n in enumerate(df.columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column"), F.lit(kind).alias("type"), F.col(f"n{i}").alias("nulls")
            )
            for i, (n, kind) in enumerate(df.dtypes)
        ]
    )
    return counted.select(F.explode(rows).alias("r"), "row_count").select(
        "r.column", "r.type", "row_count", F.col("r.nulls").alias("null_count")
    )


def verify_history(dim: DataFrame, natural_key: str = "customer_id") -> DataFrame:
    """One row of counts; both ``bad_`` columns have to be zero."""
    current = F.col("is_current")
    per_key = dim.groupBy(natural_key).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(current).alias("current"),
        F.count_if(F.col("effective_from") > F.col("effective_to")).alias("reversed"),
    )
    return per_key.agg(
        F.coalesce(F.sum("versions"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("current"), F.lit(0)).alias("current_rows"),
        F.coalesce(F.sum(F.col("versions") - F.col("current")), F.lit(0)).alias("historical_rows"),
        F.count_if(F.col("current") > 1).alias("bad_current_keys"),
        F.coalesce(F.sum("reversed"), F.lit(0)).alias("bad_date_order"),
    )


def verify_fact(fact: DataFrame) -> DataFrame:
    """Row count and repeated sale ids; raises if the columns are not the fact's."""
    if sorted(fact.columns) != sorted(FACT_COLUMNS):
        raise SchemaError(f"fact columns are {fact.columns}, expected {FACT_COLUMNS}")
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count("sale_id") - F.count_distinct("sale_id")).alias("duplicate_sale_ids"),
    )


def missing_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows miss each key."""
    return df.agg(*[F.count_if(F.col(k).isNull()).alias(f"missing_{k}") for k in keys])


def gate_lookups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Pass the frame on, or raise when any lookup key is null.

    The check is one aggregate action; only its single row reaches the driver.
    """
    require_columns(df, keys, "lookup result")
    counts = missing_keys(df, keys).first().asDict()
    failed = {k: n for k, n in counts.items() if n}
    if failed:
        raise QualityError(f"lookups without a match: {failed}")
    return df


def current_versions(dim: DataFrame, natural_key: str = "customer_id") -> DataFrame:
    """Rows marked current; without that mark the latest start per natural key."""
    if "is_current" in dim.columns:
        return dim.filter(F.col("is_current"))
    if "effective_from" in dim.columns:
        from tillwright.operators.windows import keep_last

        return keep_last(dim, [natural_key], ["effective_from"])
    return dim


def within_days(day: str, first: str | None = None, stop: str | None = None) -> Column:
    """Predicate on any day column: from ``first`` on, before ``stop``; the column stays bare."""
    bounds = {">=": first, "<": stop}
    asked = [f"`{day}` {sign} DATE '{date.fromisoformat(v)}'" for sign, v in bounds.items() if v]
    return F.expr(" AND ".join(asked) or "TRUE")


def known_status(status: str = "order_status") -> Column:
    return F.col(status).isNotNull()
