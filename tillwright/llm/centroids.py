"""Centroid clustering in whole numbers, with the equal-average equal-variance search.

A component ``x`` becomes ``floor(256 * x)``, so that sums, distances and centroids
are exact and do not depend on partitions. Centroids are sorted by the sum of their
components. A vector starts at the centroid whose sum is nearest to its own and scans
outward. With d components, sums S and W = d * (sum of squares) - S * S:

* d * distance >= (S_x - S_c)^2: once this exceeds the best distance on the nearer
  side, every centroid that is left is farther, and the vector is done;
* d * distance >= (S_x - S_c)^2 + (sqrt W_x - sqrt W_c)^2: a centroid that fails this
  is passed over without looking at its components.

What is left is compared in integers; ties go to the smaller number. A round sends the
centroids to the tasks and gets back one sum per centroid and task, added up by Spark.
The driver holds centroids only: k x d numbers, both parameters.

Defined results: a vector is kept if it has exactly ``dim`` components, none of them
null, not a number or infinite, and all within a long after scaling. Null ids are kept
with a null id and are the last to become first centroids; rows that repeat an id are
vectors of their own (of equal hash the smaller components come first). With fewer
vectors than ``k`` there are as many centroids as vectors; without a vector the result
is empty. A distance or inertia beyond a long is null. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import discard, prepare
from tillwright.session import staged

SCALE = 256
#: Longs from -2^63 up to the last double below 2^63.
LONG_SPAN = (-(2.0**63), 2.0**63)
#: Sums and bounds carry a relative error of some 1e-15 as doubles.
SLACK = 1e-9
LONG_MAX = (1 << 63) - 1


def kept_vectors(rows: DataFrame, vec_id: str, embedding: str, dim: int) -> DataFrame:
    """vec_id and the components as longs, for the vectors that count."""
    sound = F.forall(
        "raw",
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (x * SCALE >= F.lit(LONG_SPAN[0]))
        & (x * SCALE < F.lit(LONG_SPAN[1])),
    )
    raw = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("raw")
    )
    return raw.where((F.size("raw") == dim) & sound).select(
        "vec_id", F.transform("raw", lambda x: F.floor(x * SCALE)).alias("ints")
    )


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of their id."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    ordered = vectors.select(mark.alias("mark"), "ints").orderBy(F.col("mark").asc_nulls_last(), "ints")
    return [list(r.ints) for r in ordered.limit(k).collect()]


class Centroids:
    """Centroids sorted by component sum, ready for the search."""

    def __init__(self, values: list[list[int]]):
        rows = [[int(x) for x in row] for row in values]
        order = sorted(range(len(rows)), key=lambda i: (sum(rows[i]), i))
        self.number = np.array(order, np.int64)
        self.dim = len(rows[0])
        self.rows = np.array([rows[i] for i in order], object).reshape(len(rows), self.dim)
        self.sums = self.rows.sum(axis=1)
        squares = (self.rows * self.rows).sum(axis=1)
        self.spread = np.sqrt((self.dim * squares - self.sums * self.sums).astype(float))
        self.largest = max((abs(x) for row in rows for x in row), default=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and distance of the nearest centroid, and how many were compared whole.

        ``vectors`` is an array of longs. Within ``narrow`` no number here exceeds a
        long; beyond it the same steps run on Python's integers.
        """
        narrow = math.isqrt(1 << 62) // (2 * self.dim)
        big = max(self.largest, int(max(vectors.max(initial=0), -int(vectors.min(initial=0)))))
        kind = np.int64 if big < narrow else object
        x = vectors.astype(kind)
        c, sums = self.rows.astype(kind), self.sums.astype(kind)
        n, k, d = len(x), len(c), self.dim
        own = x.sum(axis=1)
        deep = np.sqrt(np.maximum((d * (x * x).sum(axis=1) - own * own).astype(float), 0.0))
        right = np.searchsorted(sums, own)
        left = right - 1
        best = np.full(n, -1, kind)
        found = np.full(n, -1, np.int64)
        compared = 0
        alive = np.arange(n)
        while len(alive):
            # The next centroid on the side that is nearer by its sum.
            low, high = left[alive], right[alive]
            below = np.where(low >= 0, own[alive] - sums[np.maximum(low, 0)], -1)
            above = np.where(high < k, sums[np.minimum(high, k - 1)] - own[alive], -1)
            go_left = ((below >= 0) & ((above < 0) | (below <= above))).astype(bool)
            gap, here = np.where(go_left, below, above), np.where(go_left, low, high)
            is_open = found[alive] < 0
            going = ((gap >= 0) & (is_open | (gap * gap <= d * best[alive]))).astype(bool)
            alive, gap, here, go_left = alive[going], gap[going], here[going], go_left[going]
            left[alive] -= go_left
            right[alive] += ~go_left
            apart = np.abs(deep[alive] - self.spread[here])
            apart = np.maximum(apart - SLACK * (deep[alive] + self.spread[here]), 0.0)
            bound = (gap.astype(float) ** 2 + apart**2) * (1 - SLACK)
            close = is_open[going] | (bound <= d * best[alive].astype(float))
            at, here = alive[close], here[close]
            compared += len(at)
            change = x[at] - c[here]
            distance, number = (change * change).sum(axis=1), self.number[here]
            nearer = (found[at] < 0) | (distance < best[at]) | ((distance == best[at]) & (number < found[at]))
            nearer = nearer.astype(bool)
            best[at[nearer]], found[at[nearer]] = distance[nearer], number[nearer]
        return found, best, compared

    def hashes(self) -> list[str]:
        """SHA-256 of every centroid's components, in the order of their numbers."""
        named = sorted(zip(self.number.tolist(), self.rows.tolist(), strict=True))
        return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for _, row in named]


def _components(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """One row per centroid and task: number, n and the components' sums as texts.

    Texts, since a task's sum may exceed a long; Spark adds them up as decimals.
    """
    dim = centroids.dim

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            x = _components(batch, dim)
            if not len(x):
                continue
            found = centroids.nearest(x)[0]
            order = np.argsort(found, kind="stable")
            numbers, starts = np.unique(found[order], return_index=True)
            sums = np.add.reduceat(x[order].astype(object), starts, axis=0) if _wide(x) else np.add.reduceat(
                x[order], starts, axis=0
            )
            counts = np.diff(np.append(starts, len(x)))
            for number, count, row in zip(numbers.tolist(), counts.tolist(), sums, strict=True):
                total = totals.setdefault(number, [0, np.zeros(dim, object)])
                total[0] += count
                total[1] = total[1] + row.astype(object)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(totals), pa.int32()),
                pa.array([t[0] for t in totals.values()], pa.int64()),
                pa.array([[str(v) for v in t[1]] for t in totals.values()], pa.list_(pa.string())),
            ],
            names=["cluster", "n", "sums"],
        )

    return vectors.mapInArrow(task, "cluster int, n long, sums array<string>")


def _wide(x: np.ndarray) -> bool:
    """Whether a batch's sums could exceed a long."""
    return bool(len(x)) and max(int(x.max()), -int(x.min())) * len(x) > LONG_MAX


def _moved(vectors: DataFrame, centroids: Centroids, values: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floor(sum / count), empty ones as they were."""
    add = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(centroids.dim)]
    totals = _sums(vectors, centroids).groupBy("cluster").agg(F.sum("n").alias("n"), *add)
    out = list(values)
    for row in totals.collect():  # one row per centroid
        out[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(centroids.dim)]
    return out


def assign(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    dim = centroids.dim

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _components(batch, dim)
            if len(x):
                found, distance, _ = centroids.nearest(x)
                longs = [int(v) if v <= LONG_MAX else None for v in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(found, pa.int32()), pa.array(longs, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return vectors.mapInArrow(task, "vec_id long, cluster int, distance long")


def cluster(
    rows: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dim: int = 64,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
) -> tuple[DataFrame, list[list[int]]]:
    """The assignment of every kept vector, and the final centroids by number.

    Columns: vec_id, cluster, distance, cluster_inertia and inertia (sums of the
    distances over the cluster and over all), centroid_sha256.
    """
    spark = prepare(rows.sparkSession)
    vectors, path = staged(kept_vectors(rows, vec_id, embedding, dim), "vectors")
    values = first_centroids(vectors, k, seed)
    if not values:
        discard(spark, path)
        return _empty(spark), []
    for _ in range(rounds):
        values = _moved(vectors, Centroids(values), values)
    final = Centroids(values)
    found, _ = staged(assign(vectors, final), "assigned")
    discard(spark, path)
    # One row per centroid; a distance beyond a long makes its sums null as well.
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    totals = {r.cluster: r.total for r in found.groupBy("cluster").agg(whole.alias("total")).collect()}

    def as_long(value) -> int | None:
        return int(value) if value is not None and value <= LONG_MAX else None

    every = None if None in totals.values() else sum(totals.values())
    hashes = final.hashes()
    facts = spark.createDataFrame(
        [(number, as_long(total), as_long(every), hashes[number]) for number, total in totals.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    ), values


def _empty(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string",
    )
