"""Nearest stored vectors to query vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Stored vectors and probes of one comparison; more of either make more groups.
STORE_BLOCK = 50_000
PROBE_BLOCK = 2_000


def _matrix(column: pa.ChunkedArray, length: int | None = None) -> np.ndarray:
    """Vectors as rows; all must have the same length, and ``length`` if that is given."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    if len(set(sizes.tolist()) | ({length} if length else set())) > 1:
        raise ValueError(f"vectors differ in length: {sorted(set(sizes.tolist()))}, probes {length}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(sizes), -1)


def nearest(
    store: DataFrame,
    probes: DataFrame,
    k: int,
    id_column: str = "vec_id",
    probe_column: str = "probe_id",
) -> DataFrame:
    """The k nearest stored vectors (L2) of each probe, nearest first, ties by id.

    Both sides have their vector in ``embedding``. Store and probes are dealt into
    blocks of bounded size, every pair of blocks is compared as matrices in one task
    and sends on k rows per probe; the last k are chosen among those. Null vectors take
    no part; vectors of differing length are an error.
    """
    k = max(1, k)

    def dealt(df: DataFrame, name: str, size: int) -> tuple[DataFrame, int]:
        there = df.filter(F.col("embedding").isNotNull()).select(
            F.col(name).cast("bigint").alias(name), "embedding"
        )
        blocks = max(1, -(-there.count() // size))
        return there.withColumn("own", F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")), blocks

    kept, n_store = dealt(store, id_column, STORE_BLOCK)
    asked, n_probes = dealt(probes, probe_column, PROBE_BLOCK)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = kept.withColumn("other", every(n_probes)).select(
        F.col("own").alias("store_block"), F.col("other").alias("probe_block"), id_column, "embedding"
    )
    right = asked.withColumn("other", every(n_store)).select(
        F.col("other").alias("store_block"), F.col("own").alias("probe_block"), probe_column, "embedding"
    )

    def best(stored: pa.Table, wanted: pa.Table) -> pa.Table:
        names = [id_column, probe_column, "distance"]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        out: list[list] = [[], [], []]
        if stored.num_rows and wanted.num_rows:
            ids = stored.column(id_column).to_numpy()
            targets = _matrix(wanted.column("embedding"))
            matrix = _matrix(stored.column("embedding"), targets.shape[1])
            for probe, target in zip(wanted.column(probe_column).to_pylist(), targets, strict=True):
                distance = np.sqrt(((matrix - target) ** 2).sum(axis=1))
                chosen = np.lexsort((ids, distance))[:k]
                out[0] += ids[chosen].tolist()
                out[1] += [probe] * len(chosen)
                out[2] += distance[chosen].tolist()
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names)

    keys = ["store_block", "probe_block"]
    candidates = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        best, f"{id_column} bigint, {probe_column} bigint, distance double"
    )
    window = Window.partitionBy(probe_column).orderBy("distance", id_column)
    return candidates.withColumn("position", F.row_number().over(window)).filter(
        F.col("position") <= k
    )
