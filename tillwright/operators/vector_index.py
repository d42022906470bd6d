"""Exact nearest vectors with a stored index of cells around pivots.

Every vector lies in the cell of its nearest pivot and is stored with its distance r to it;
a cell has its greatest r as radius R. For a probe at distance d from a pivot, the triangle
inequality says that a vector of its cell is at least |d - r| away, and none is nearer than
d - R. So, with any bound b on the distance of the k-th neighbour, cells with d - R > b and
vectors with |d - r| > b are ruled out without being looked at. The bound comes first from
the cells' sizes alone, then from the vectors of the probe's nearest cell. What is left is
compared, so the answer is that of a comparison with all vectors.

Cells and probes are dealt into blocks of bounded size, hence a cell or a probe list that
holds much of all rows is spread over many tasks. The driver holds the pivots: ``pivots``
times the vectors' length, both bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.operators.vectors import _matrix
from tillwright.session import staged

#: Rows of a cell, and probes that ask for it, in one comparison.
CELL_BLOCK, PROBE_BLOCK = 20_000, 2_000
#: Vectors looked at to choose a pivot among.
CHOICE = 16
#: Distances are rounded; what a bound rules out is ruled out by more than this share.
SLACK = 1e-9


def _flat(batch: pa.RecordBatch, name: str, length: int | None = None) -> np.ndarray:
    return _matrix(pa.chunked_array([batch.column(name)]), length)


def choose_pivots(vectors: np.ndarray, pivots: int) -> np.ndarray:
    """Vectors that are far from each other: each is the farthest from those before it."""
    chosen = [0] if len(vectors) else []
    far = ((vectors - vectors[0]) ** 2).sum(1) if chosen else np.zeros(0)
    while len(chosen) < pivots and far.max(initial=0) > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
    return vectors[chosen]


@dataclass
class VectorIndex:
    """A stored index: the vectors by cell, and the cells."""

    spark: SparkSession
    path: str
    id_column: str

    @staticmethod
    def build(
        store: DataFrame, path: str, pivots: int | None = None, id_column: str = "vec_id"
    ) -> VectorIndex:
        """Index every vector that is not null; all must have one length.

        ``pivots`` are about the root of the number of vectors, 1,024 at most, chosen from
        CHOICE times as many vectors with the smallest hashes of their ids.
        """
        spark = store.sparkSession
        there = store.filter(F.col("embedding").isNotNull()).select(
            F.col(id_column).cast("bigint").alias(id_column), "embedding"
        )
        n = there.count()
        pivots = pivots or int(min(1024, max(1, n**0.5)))
        order = [F.xxhash64(id_column), F.col(id_column)]
        sample = there.orderBy(*order).limit(pivots * CHOICE).toArrow()
        points = _matrix(sample.column("embedding")) if sample.num_rows else np.zeros((0, 0))
        centers = choose_pivots(points, pivots)
        schema = f"{id_column} bigint, embedding {there.schema['embedding'].dataType.simpleString()}, cell int, r double"

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = _flat(batch, "embedding", centers.shape[1])
                cell, r = np.zeros(len(own), np.int32), np.zeros(len(own))
                for start in range(0, len(own), 512):
                    part = slice(start, start + 512)
                    distance = _distances(own[part], centers)
                    cell[part] = distance.argmin(1)
                    r[part] = distance[np.arange(len(distance)), cell[part]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_column), batch.column("embedding"), pa.array(cell), pa.array(r)],
                    [id_column, "embedding", "cell", "r"],
                )

        placed = there.mapInArrow(assign, schema) if len(centers) else spark.createDataFrame([], schema)
        # Sorted by cell, so that a scan for some cells skips the row groups of the others.
        placed.repartitionByRange("cell", "r").sortWithinPartitions("cell", "r").write.parquet(f"{path}/vectors")
        sizes = spark.read.schema(schema).parquet(f"{path}/vectors").groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.max("r").alias("radius")
        )
        names = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cell int, pivot array<double>")
        names.join(sizes, "cell").write.parquet(f"{path}/cells")
        return VectorIndex(spark, path, id_column)

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    @property
    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    def nearest(self, probes: DataFrame, k: int, probe_column: str = "probe_id") -> Found:
        """The k nearest vectors (L2) of each probe, nearest first, ties by id."""
        k = max(1, k)
        cells = sorted(self.cells.collect(), key=lambda c: c["cell"])  # one row per pivot
        asked = probes.filter(F.col("embedding").isNotNull()).select(
            F.col(probe_column).cast("bigint").alias("probe"), "embedding"
        )
        wanted, _ = staged(_wanted(asked, cells, k), "probe-cells")
        first, _ = staged(self._compared(wanted.filter("nearest"), cells, k), "near-cells")
        # The k-th best of the nearest cell, where it has so many.
        kth = first.filter("compared IS NULL").groupBy("probe").agg(
            F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("kth")
        )
        rest = wanted.filter("NOT nearest").join(kth, "probe", "left").withColumn(
            "bound", F.least("bound", "kth")
        )
        rest = rest.filter(F.col("d") - F.col("radius") <= F.col("bound") * (1 + SLACK) + SLACK).drop("kth")
        second, _ = staged(self._compared(rest, cells, k), "far-cells")
        both = first.unionByName(second)
        window = Window.partitionBy("probe").orderBy("distance", "id")
        best = both.filter("compared IS NULL").withColumn("position", F.row_number().over(window))
        rows = best.filter(F.col("position") <= k).select(
            F.col("id").alias(self.id_column), F.col("probe").alias(probe_column), "distance", "position"
        )
        pairs = asked.agg(F.count(F.lit(1)) * F.lit(sum(c["n"] for c in cells)))
        return Found(rows, both.agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared")), pairs)

    def _compared(self, wanted: DataFrame, cells: list, k: int) -> DataFrame:
        """(id, probe, distance): the k best of each block for each probe that asks for it.

        One more row per comparison has only ``compared``, the number of pairs looked at.
        """
        blocks = {c["cell"]: max(1, -(-c["n"] // CELL_BLOCK)) for c in cells}
        asking = {r["cell"]: r["n"] for r in wanted.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        lists = {c: max(1, -(-n // PROBE_BLOCK)) for c, n in asking.items()}
        dealt = self.spark.createDataFrame(
            [(c, blocks[c], lists[c]) for c in lists], "cell int, blocks int, lists int"
        )
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        stored = self.vectors.filter(F.col("cell").isin(list(lists))).join(F.broadcast(dealt), "cell")
        left = stored.withColumn("block", F.pmod(F.xxhash64(self.id_column), "blocks").cast("int")).select(
            "cell", "block", every("lists").alias("list"), F.col(self.id_column).alias("id"), "embedding", "r"
        )
        own = wanted.join(F.broadcast(dealt), "cell")
        right = own.withColumn("list", F.pmod(F.xxhash64("probe"), "lists").cast("int")).select(
            "cell", every("blocks").alias("block"), "list", "probe", "embedding", "d", "bound"
        )

        def best(vectors: pa.Table, asked: pa.Table) -> pa.Table:
            out: list[list] = [[], [], []]
            compared = 0
            if vectors.num_rows and asked.num_rows:
                order = np.argsort(vectors.column("r").to_numpy(), kind="stable")
                r = vectors.column("r").to_numpy()[order]
                ids = vectors.column("id").to_numpy()[order]
                targets = _matrix(asked.column("embedding"))
                matrix = _matrix(vectors.column("embedding"), targets.shape[1])[order]
                d, bound = asked.column("d").to_numpy(), asked.column("bound").to_numpy()
                reach = bound * (1 + SLACK) + SLACK * (1 + d)
                low = np.searchsorted(r, d - reach, "left")
                high = np.searchsorted(r, d + reach, "right")
                for i, probe in enumerate(asked.column("probe").to_pylist()):
                    part = slice(low[i], high[i])
                    distance = np.sqrt(((matrix[part] - targets[i]) ** 2).sum(axis=1))
                    compared += len(distance)
                    chosen = np.lexsort((ids[part], distance))[:k]
                    out[0] += ids[part][chosen].tolist()
                    out[1] += [probe] * len(chosen)
                    out[2] += distance[chosen].tolist()
            n = len(out[0])
            return pa.table(
                [
                    pa.array([*out[0], None], pa.int64()), pa.array([*out[1], None], pa.int64()),
                    pa.array([*out[2], None], pa.float64()), pa.array([None] * n + [compared], pa.int64()),
                ],
                ["id", "probe", "distance", "compared"],
            )

        keys = ["cell", "block", "list"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            best, "id bigint, probe bigint, distance double, compared bigint"
        )


@dataclass(frozen=True)
class Found:
    """The neighbours; how many pairs were compared, and how many there are in all."""

    rows: DataFrame
    compared: DataFrame
    pairs: DataFrame

    def share(self) -> float:
        every = self.pairs.first()[0]
        return self.compared.first()[0] / every if every else 0.0


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of two matrices, by differences, so that equal rows are at 0."""
    out = np.empty((len(a), len(b)))
    for j, row in enumerate(b):
        out[:, j] = np.sqrt(((a - row) ** 2).sum(axis=1))
    return out


def _wanted(asked: DataFrame, cells: list, k: int) -> DataFrame:
    """The cells that a probe has to look at: its distance to their pivot and its bound.

    The bound is the least b for which cells that lie within b whole have k vectors.
    """
    kind = asked.schema["embedding"].dataType.simpleString()
    schema = f"probe bigint, embedding {kind}, cell int, d double, radius double, bound double, nearest boolean"
    if not cells:
        return asked.sparkSession.createDataFrame([], schema)
    numbers = np.array([c["cell"] for c in cells], np.int32)
    centers = np.array([c["pivot"] for c in cells])
    sizes = np.array([c["n"] for c in cells])
    radius = np.array([c["radius"] for c in cells])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = _distances(_flat(batch, "embedding", centers.shape[1]), centers)
            outer = d + radius
            order = np.argsort(outer, axis=1)
            enough = np.minimum((np.cumsum(sizes[order], axis=1) < k).sum(1), len(cells) - 1)
            bound = np.take_along_axis(np.sort(outer, axis=1), enough[:, None], 1)[:, 0]
            bound[sizes.sum() < k] = np.inf
            nearest = d.argmin(1)
            asks = d - radius <= (bound * (1 + SLACK) + SLACK)[:, None]
            asks[np.arange(len(d)), nearest] = True
            row, cell = np.nonzero(asks)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("probe").take(at), batch.column("embedding").take(at), pa.array(numbers[cell]),
                    pa.array(d[row, cell]), pa.array(radius[cell]), pa.array(bound[row]),
                    pa.array(nearest[row] == cell),
                ],
                ["probe", "embedding", "cell", "d", "radius", "bound", "nearest"],
            )

    return asked.mapInArrow(look, schema)
