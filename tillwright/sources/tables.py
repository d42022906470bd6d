"""Named tables: scan, register, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwright.sources import storage


class Warehouse:
    """Parquet tables below one base folder, addressed by name."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def has_folder(self, path: str) -> bool:
        return storage.exists(self.spark, path)

    def has(self, name: str) -> bool:
        return storage.has_table(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        if not self.has(name):
            raise LookupError(f"table {name} does not exist below {self.base}")
        return storage.read_table(self.spark, self.path(name))

    def read_or_none(self, name: str) -> DataFrame | None:
        return storage.read_table(self.spark, self.path(name)) if self.has(name) else None


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name."""
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name} does not exist")
    return spark.table(name)


def register(tables: dict[str, DataFrame]) -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def preview(tables: dict[str, DataFrame], name: str, limit: int = 10) -> DataFrame:
    if name not in tables:
        raise LookupError(f"unknown table {name}; there are {sorted(tables)}")
    return tables[name].limit(max(1, limit))
