"""The vector index against a comparison with all vectors."""

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwright.operators import vector_index, vectors
from tillwright.operators.vector_index import VectorIndex


def frame(spark, name, records):
    return spark.createDataFrame(
        [(i, None if v is None else [float(x) for x in v]) for i, v in records], f"{name} long, embedding array<double>"
    )


@pytest.mark.parametrize("k", [1, 5, 60])
def test_index_equals_brute_force(spark, folder, monkeypatch, k):
    monkeypatch.setattr(vector_index, "CELL_BLOCK", 40)
    monkeypatch.setattr(vector_index, "PROBE_BLOCK", 7)
    rng = np.random.default_rng(k)
    centers = rng.normal(0, 10, (12, 8))
    points = centers[rng.integers(0, 12, 400)] + rng.normal(0, 0.5, (400, 8))
    points[50:180] = points[50]  # a third of all are one vector
    store = frame(spark, "vec_id", [*enumerate(points), (999, None)])
    asked = np.concatenate([points[:20] + 0.01, rng.normal(0, 10, (10, 8)), points[50:52]])
    probes = frame(spark, "probe_id", [*enumerate(asked), (77, None)])
    index = VectorIndex.build(store, folder, pivots=20)
    found = index.nearest(probes, k)
    assert rows(found.rows) == rows(vectors.nearest(store, probes, k).select(found.rows.columns))
    assert 0 < found.share() < (0.6 if k == 1 else 1.01)
    assert index.cells.agg(F.sum("n")).first()[0] == 400


def test_index_edges(spark, folder):
    store = frame(spark, "vec_id", [(1, [0, 0]), (2, [3, 4]), (2, [3, 4]), (5, [0, 0])])
    index = VectorIndex.build(store, f"{folder}/a")
    probes = frame(spark, "probe_id", [(1, [0, 0]), (2, [3, 4])])
    found = index.nearest(probes, 10)
    assert rows(found.rows) == rows(vectors.nearest(store, probes, 10).select(found.rows.columns))
    assert index.nearest(probes.limit(0), 3).rows.count() == 0
    assert index.nearest(probes.limit(0), 3).share() == 0.0
    empty = VectorIndex.build(store.limit(0), f"{folder}/b")
    assert empty.nearest(probes, 3).rows.count() == 0
    with pytest.raises(Exception, match="length"):
        VectorIndex.build(store.union(frame(spark, "vec_id", [(9, [1, 2, 3])])), f"{folder}/c")


def test_given_vectors(spark, folder, data):
    store = spark.read.parquet(f"{data}/embeddings.parquet")
    probes = store.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("probe_id"), "embedding")
    found = VectorIndex.build(store, folder).nearest(probes, 5)
    assert rows(found.rows) == rows(vectors.nearest(store, probes, 5).select(found.rows.columns))
    assert found.share() < 1
