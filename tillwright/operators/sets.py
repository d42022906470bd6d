"""Unions, duplicates and key sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_NUMERIC = [*_WHOLE, T.FloatType(), T.DoubleType()]


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name, missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: numbers widen, dates become timestamps, else text."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in _NUMERIC and b in _NUMERIC:
        if (a in _WHOLE) != (b in _WHOLE):
            return T.DoubleType()
        return max(a, b, key=_NUMERIC.index)
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, moments) and isinstance(b, moments):
        return a if isinstance(b, T.DateType) else b
    return T.StringType()


def union_relaxed(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name where columns may differ in type; both sides are widened."""
    frames = [first, *others]
    types: dict[str, T.DataType] = {}
    for df in frames:
        for field in df.schema.fields:
            types[field.name] = wider(types.get(field.name, field.dataType), field.dataType)
    widened = [
        df.select(*[F.col(n).cast(types[n]).alias(n) for n in df.columns]) for df in frames
    ]
    return union_by_name(*widened)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    """Distinct combinations, rows with a null in them left out."""
    return df.select(*names).dropna().distinct()


def key_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every key with the side it occurs on: ``both``, ``left`` or ``right``."""
    sides = left.select(key, F.lit(1).alias("side")).unionByName(
        right.select(key, F.lit(2).alias("side"))
    )
    found = sides.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.bool_or(F.col("side") == 1).alias("l"), F.bool_or(F.col("side") == 2).alias("r")
    )
    where = F.when(F.col("l") & F.col("r"), "both").when(F.col("l"), "left").otherwise("right")
    return found.select(key, where.alias("found_in"))
