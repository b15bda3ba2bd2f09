import hashlib
import math

import numpy as np
import pytest
from llm_helpers import SF, check_oracle

from cartwheel.llm import va_cluster as va


def brute(rows, dims, k, rounds=3, scale=64):
    """(vec_id, cluster, distance) rows and the centroids, in Python's whole numbers."""
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, tuple(math.floor(max(-va.LIMIT, min(va.LIMIT, c * scale))) for c in x)))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b)**2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (_, n) in zip(kept, at, strict=True) if n == c]
            if mine:
                centroids[c] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    return sorted(((i, n, d) for (i, _), (d, n) in zip(kept, assign(), strict=True)), key=repr), centroids


def check(spark, rows, dims=4, k=3, rounds=3):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = va.cluster(df, dims=dims, k=k, rounds=rounds)
    expected, centroids = brute(rows, dims, k, rounds)
    assert sorted((tuple(r) for r in got.assigned.collect()), key=repr) == expected
    assert got.centroids.tolist() == [list(c) for c in centroids]
    sums = {}
    for _, n, d in expected:
        sums[n] = sums.get(n, 0) + d
    assert got.inertia == sums
    return got


def test_oracle(spark):
    check_oracle(spark, "op12_clusters", SF)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(size=4) + 3 * (k % 3)).tolist()) for k in range(200)]
    rows += [(1000, None), (1001, []), (1002, [1.0] * 3), (1003, [1.0] * 5), (1004, [1.0, None, 1.0, 1.0]),
             (1005, [1.0, math.nan, 1.0, 1.0]), (1006, [math.inf] * 4), (1007, [1e-9, -1e-9, 0.0, -0.0]),
             (None, [0.5] * 4), (5, rows[5][1]), (5, rows[6][1])]
    check(spark, rows)


def test_extreme_components_count_as_the_limit(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=4).tolist()) for k in range(50)] + [(60, [1e308] * 4), (61, [-1e300, 1e30, 0.0, 3e7])]
    check(spark, rows)


def test_ties_and_repeated_vectors(spark):
    """All vectors on a coarse grid: many equal distances, and a third of them one vector."""
    rng = np.random.default_rng(9)
    rows = [(k, (rng.integers(0, 3, 4) / 64.0).tolist() if k % 3 else [0.0] * 4) for k in range(150)]
    check(spark, rows, k=5)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_fewer_vectors_than_centroids(spark, n):
    check(spark, [(k, [float(k), 0.0, 0.0, 0.0]) for k in range(n)], k=16)


def test_empty_tables(spark):
    schema = "vec_id bigint, embedding array<float>, label int, row string, cells string, v string"
    assert va.cluster(spark.createDataFrame([], schema)) is None
    assert va.cluster(spark.createDataFrame([(1, [1.0], 2, "r", "c", "v")], schema)) is None


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(11)
    v = rng.integers(-300, 300, (500, 6))
    v[0, 0] = va.LIMIT
    edges = va.edges_of(v[100:200])
    centroids = rng.integers(-300, 300, (7, 6))
    cells = va.cells_unpacked(va.cells_packed(va.cells_of(v, edges)), 6)
    assert (cells == va.cells_of(v, edges)).all()
    low, high = (sum(t[d][cells[:, d]] for d in range(6)) for t in va.lookup(centroids, edges))
    exact = ((v[:, None, :] - centroids)**2).sum(axis=2)
    assert (low <= exact).all() and (exact <= high).all()
    open_ = va.possible(cells, va.lookup(centroids, edges))
    assert open_[np.arange(len(v)), exact.argmin(axis=1)].all()
    assert (va.nearest(v, open_, centroids) == exact.argmin(axis=1)).all()


def test_settled_vectors_are_not_fetched(spark):
    """Groups far apart: the intervals settle nearly all vectors after the first round."""
    rng = np.random.default_rng(13)
    rows = [(k, (rng.normal(size=8) * 0.2 + 20 * (k % 4)).tolist()) for k in range(2000)]
    got = check(spark, rows, dims=8, k=4, rounds=4)
    assert len(got.fetched) == 3 and got.fetched[-1] < 400
