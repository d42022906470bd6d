"""Export: values a relational target can hold, and all-or-nothing publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.operators.clean import null_columns_to_string
from tillwright.sources import storage
from tillwright.sources.sinks import write_version

_ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _iso(moment: Column) -> Column:
    """ISO text; the fraction appears only when there is one."""
    whole = F.date_format(moment, _ISO_SECONDS)
    fraction = F.date_format(moment, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def relational_value(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(c), c)
    elif isinstance(kind, T.DateType):
        value = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = _iso(c)
    elif isinstance(kind, T.BooleanType):
        value = c.cast("int")
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        value = F.to_json(c)
    elif isinstance(kind, (T.IntegralType, T.StringType, T.BinaryType)):
        value = c
    else:  # decimals keep their digits as text, anything else becomes text too
        value = c.cast("string")
    return value.alias(field.name)


def relational_form(df: DataFrame) -> DataFrame:
    """Every column in a form a relational table can hold, chosen from its type."""
    return df.select(*[relational_value(f) for f in df.schema.fields])


def publish(spark: SparkSession, tables: dict[str, DataFrame], base: str) -> dict[str, int]:
    """Write every table, check every count, then show all by one statement.

    Until then readers see the tables as they were. The count that a table should have
    is observed while it is written, so each plan runs once. Tables that were published
    before and are not among these stay.
    """
    base = base.rstrip("/")
    expected: dict[str, int] = {}
    ready: dict[str, storage.Shown] = {}
    for name, df in tables.items():
        form = relational_form(null_columns_to_string(df))
        ready[name], expected[name] = write_version(form, f"{base}/{name}", allow_empty=True)
        found = storage.read_shown(spark, ready[name]).count()
        if found != expected[name]:
            raise RuntimeError(f"{name}: wrote {found} rows, expected {expected[name]}")
    storage.show_together(spark, base, ready)
    return expected


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A published table, as the catalogue shows it."""
    shown = storage.shown_together(spark, base.rstrip("/"))
    if name not in shown:
        raise LookupError(f"table {name} is not published below {base}")
    return storage.read_shown(spark, shown[name])
