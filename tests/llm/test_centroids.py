"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from tillwright.llm.centroids import Centroids, cluster

ROWS = "vec_id long, embedding array<double>, label int, ints string, cluster string, distance int"


def frame(spark, rows):
    """Rows with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, v, 0, "x", "y", 1) for i, v in rows], ROWS)


def plain(rows, dim, k, rounds):
    """The contract, written out with Python's integers."""
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None
        and len(v) == dim
        and all(x is not None and math.isfinite(x) and -(2**63) <= 256 * x < 2**63 for x in v)
    ]
    mark = [(i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept]
    centroids = [v for _, _, v in sorted(mark)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, own in groups.items():
            centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, n, distance in found:
        inertia[n] = inertia.get(n, 0) + distance
    long = lambda x: x if x < 2**63 else None
    total = sum(inertia.values())
    return sorted(
        (
            (i, n, long(x), long(inertia[n]), long(total), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
            for i, n, x in found
        ),
        key=repr,
    )


def found(spark, rows, **more):
    return sorted(map(tuple, cluster(frame(spark, rows), **more)[0].collect()), key=repr)


@pytest.mark.parametrize("dim,k,spread", [(1, 3, 1.0), (4, 40, 0.01), (64, 40, 1.0), (7, 5, 300.0)])
def test_against_plain(spark, dim, k, spread):
    rng = np.random.default_rng(dim)
    rows = [(i, list(map(float, rng.normal(0, spread, dim)))) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # a hot vector
    assert found(spark, rows, dim=dim, k=k) == plain(rows, dim, k, 5)


def test_search_is_exact_and_passes_over():
    rng = np.random.default_rng(5)
    for scale in (3, 500, 1 << 22, 1 << 40):
        centroids = [[int(v) for v in row] for row in rng.integers(-scale, scale, (40, 16))]
        centroids[7] = list(centroids[3])  # a tie that the smaller number wins
        # The same sum as another centroid, so that only the deviation tells them apart.
        centroids[9] = centroids[3][::-1]
        vectors = np.array([[int(v) for v in row] for row in rng.integers(-scale, scale, (300, 16))], np.int64)
        vectors[:40] = np.array(centroids)
        vectors[40:80] = np.array(centroids) // 2
        number, distance, compared = Centroids(centroids).nearest(vectors)
        for v, n, x in zip(vectors.tolist(), number.tolist(), distance.tolist(), strict=True):
            assert (x, n) == min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))
        assert compared < 0.9 * 300 * 40


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0]),
        (1, [0.5, 1.0]),
        (1, [3.0, 1.0]),
        (None, [9.0, 9.0]),
        (None, None),
        (2, []),
        (3, [1.0]),
        (4, [1.0, None]),
        (5, [1.0, nan]),
        (6, [inf, 1.0]),
        (7, [1.0, 2.0, 3.0]),
        (8, [1e300, 1.0]),
        (9, [-0.001, 0.001]),
        (10, [1e15, -1e15]),
        (-4, [1e15, 0.0]),
    ]
    for k in (1, 2, 4, 40):
        assert found(spark, rows, dim=2, k=k, rounds=3) == plain(rows, 2, k, 3)
    assert len(found(spark, rows, dim=2)) == 7


def test_empty(spark):
    answer, centroids = cluster(frame(spark, []))
    assert answer.collect() == [] and centroids == []
    assert cluster(frame(spark, [(1, [1.0])]))[0].collect() == []


def test_floats_as_doubles(spark):
    rows = spark.createDataFrame([(1, [0.1, 0.7]), (2, [0.3, -0.3])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, cluster(rows, dim=2)[0].collect()))
    wide = [(1, [float(np.float32(x)) for x in (0.1, 0.7)]), (2, [float(np.float32(x)) for x in (0.3, -0.3)])]
    assert got == plain(wide, 2, 40, 5)
