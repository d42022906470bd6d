"""Incremental loads: find new files, read only those, run the job, then mark them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.plans import curate
from tillwright.sources.files import read_csv_checked, split_lines
from tillwright.sources.sinks import write_quarantine
from tillwright.sources.tables import Warehouse
from tillwright.streaming import ledger

# The order in which datasets are loaded: orders refer to the others.
ORDER = ("customers", "products", "orders", "orders_enriched")


@dataclass(frozen=True)
class Load:
    """What one run did with one dataset; ``broken`` lines went to quarantine."""

    dataset: str
    files: int
    rows: int
    broken: int = 0


def new_files(zones: Warehouse, folder: str, dataset: str) -> DataFrame:
    """Files below the dataset's folder that the ledger doesn't know as they are now."""
    files = ledger.list_files(zones.spark, folder, dataset)
    known = ledger.read_ledger(zones)
    if known is not None:
        known = known.filter(F.col("dataset") == dataset)
    return ledger.new_or_changed(files, known)


def load_new(
    zones: Warehouse, dataset: str, folder: str, at: str | None = None, **options
) -> Load:
    """One dataset: nothing is read or marked if no file is new or changed.

    Only the names of the new files come to the driver. Lines that do not fit their file's
    header go to ``quarantine/<dataset>_lines`` with their text and file. Files are marked
    after their rows are in the tables, so a failed run is repeated and applies the same
    changes.
    """
    found = new_files(zones, folder, dataset).collect()
    if not found:
        return Load(dataset, 0, 0)
    base = folder.rstrip("/")
    good, broken = split_lines(read_csv_checked(zones.spark, [f"{base}/{r['path']}" for r in found]))
    # The same files always make the same folder, so a repeated run replaces its lines.
    batch = options.get("batch") or hashlib.sha256(repr(sorted(map(tuple, found))).encode()).hexdigest()[:32]
    n_broken = write_quarantine(broken, zones.path(f"quarantine/{dataset}_lines"), batch)
    rows = curate.load(zones, dataset, good, at=at, **options)
    marked = zones.spark.createDataFrame(found)
    ledger.mark_processed(zones, marked, at, records=rows)
    return Load(dataset, len(found), rows, n_broken)


def run(
    spark: SparkSession, raw: str, base: str, at: str | None = None, **options
) -> list[Load]:
    """Every dataset that has a folder below ``raw``, then the daily summary if orders changed."""
    zones = Warehouse(spark, base)
    loads = [
        load_new(zones, name, f"{raw.rstrip('/')}/{name}", at, **options)
        for name in ORDER
        if zones.has_folder(f"{raw.rstrip('/')}/{name}")
    ]
    if any(load.rows for load in loads if load.dataset == "orders"):
        curate.load_order_summary(zones, at)
    return loads
