"""The shape of the plans: what is pushed down, limited early, never crossed."""

import pytest
from helpers import plan

import __spark_entry__ as entry
from tillwright.catalogue.base import Tables
from tillwright.operators import clean, quality, windows
from tillwright.plans import analytics
from tillwright.sources import bridge, files
from tillwright.sources.storage import read_table


@pytest.fixture
def t(spark, data):
    return Tables(spark, data)


def test_filter_reaches_the_scan(t):
    orders = t.orders.withColumnsRenamed(
        {"o_orderdate": "order_date", "o_orderstatus": "order_status"}
    )
    text = plan(orders.where(quality.within_days("order_date", "1996-01-01", "1996-04-01")).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_rules_read_columns_that_are_computed_once(t):
    """Every cast stands once in the plan, and the orders are read once for both outcomes."""
    typed = clean.cast_orders(bridge.raw_orders(t))
    valid, _ = quality.split_valid(typed, quality.order_rules())
    text = valid._jdf.queryExecution().optimizedPlan().toString()
    casts = text.count("try_cast(trim(") + text.count("cast(trim(")
    plain = typed._jdf.queryExecution().optimizedPlan().toString()
    assert casts == plain.count("try_cast(trim(") + plain.count("cast(trim(")
    assert text.count("Relation ") == plain.count("Relation ")


def test_outcomes_are_one_write(spark, t, folder):
    from tillwright.sources import storage

    typed = clean.cast_orders(bridge.raw_orders(t))
    marked = typed.withColumn("is_delete", quality.is_delete(typed))
    found = quality.write_outcomes(quality.classify(marked, quality.order_rules()), folder, "is_delete")
    assert sum(found.counts.values()) == typed.count() and all(found.counts.values())
    for rows, name in ((found.valid, "valid"), (found.rejected, "rejected"), (found.deletes, "deleted")):
        assert rows.count() == found.counts[name]
        assert all(f"outcome={name}/" in f for f in rows.inputFiles())
    assert storage.exists(spark, f"{folder}/_SUCCESS")


def test_months_are_pruned_through_the_dimension(spark, t, folder):
    analytics.load_fact_by_month(bridge.fact_sales(t), folder)
    fact = read_table(spark, folder)
    asked = analytics.category_revenue(
        fact, bridge.dim_product(t), bridge.dim_date(t), "1996-02-01", "1996-04-01"
    )
    asked.collect()
    text = plan(asked)
    assert "dynamicpruning" in text.lower()
    scans = {}

    def visit(node):
        if node.nodeName().startswith("Scan parquet") and "month_key" in node.toString():
            files = node.metrics().get("numFiles")
            scans[node.id()] = files.get().value() if files.isDefined() else None
        kids = list(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(node.children()))
        for kid in kids:
            visit(kid)
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            visit(node.executedPlan())
        if "QueryStage" in node.nodeName():
            visit(node.plan())

    visit(asked._jdf.queryExecution().executedPlan())
    months = fact.select("month_key").distinct().count()
    assert 0 < max(scans.values()) <= 0.1 * max(months, len(fact.inputFiles()))


def test_only_the_asked_column_is_read(t):
    assert "ReadSchema: struct<o_custkey:bigint>" in plan(files.read_columns(t.orders, "o_custkey"))


def test_keep_last_limits_before_the_shuffle(t):
    text = plan(windows.keep_last(bridge.order_lines(t), ["order_id"], ["arrived_on"]))
    final, partial = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert final < text.index("Exchange hashpartitioning(order_id") < partial


def test_top_products_joins_after_the_sum(t):
    text = plan(entry.queries()["q1_top_products"](t.spark, t.folder))
    assert text.index("Join") < text.index("partial_sum(quantity")
    assert "l_orderkey" not in text.split("ReadSchema")[-1]
    assert "TakeOrderedAndProject" in text


LAZY = [
    name
    for name in entry.queries()
    if name.startswith(("q", "jn_", "ag_", "dq_", "flt_", "prj_", "so_", "st_", "template_"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, data, name):
    text = plan(entry.queries()[name](spark, data))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
