"""The key filter: exact results, few rows that pass by chance."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwright.operators.key_filter import KeyFilter, semi_join


def test_exact_and_selective(spark):
    facts = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("part"), F.lit("x").alias("bitmap"))
    reference = spark.range(0, 20_000, 10).select(F.col("id").cast("string").alias("k"))
    own = KeyFilter.build(reference, "k", facts.schema["k"].dataType)
    let_through = own.possible(facts, "k").count()
    assert 2000 <= let_through <= 2000 + 0.04 * 18_000
    assert rows(semi_join(facts, reference, "k")) == rows(facts.where("k % 10 = 0"))


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_edges(spark, kind):
    values = {"int": [1, 2, None, -5], "string": ["a", "", None, "é"], "date": ["2024-01-01", "1970-01-01", None, "1900-02-03"]}[kind]
    df = spark.createDataFrame([(str(v) if v is not None else None,) for v in values], "k string").select(F.col("k").cast(kind))
    ref = df.limit(2).union(df.where("k IS NULL"))
    assert semi_join(df, ref, "k").count() == 2
    assert semi_join(df, df.limit(0), "k").count() == 0
    assert semi_join(df.limit(0), ref, "k").count() == 0
    assert semi_join(df.union(df), df, "k").count() == 6
