"""Screened k-means against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docforge.llm import centroids
from docforge.llm.queries import op11_centroid_clustering


def brute(rows, size, scale, k, rounds, seed):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, v) for i, v in kept if all(abs(x) < centroids.LARGEST for x in v)]
    digest = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), np.array(r[1], "<i4").tobytes()))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = assign()
    inertia = {}
    for d, c in found:
        inertia[c] = inertia.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(kept, found, strict=True)), key=str)


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 10).tolist()) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (7, rows[8][1]), (7, rows[8][1]), (None, rows[3][1]), (102, None), (103, []), (104, [1.0] * 9), (105, [None] + [1.0] * 9), (106, [float("nan")] * 10), (107, [float("inf")] * 10), (108, [3e38] * 10), (109, [0.0] * 10), (110, [-5e4] * 10)]
    df = spark.createDataFrame([(v, i, "x") for i, v in rows], "embedding array<float>, vec_id long, cluster string").repartition(5)
    have = centroids.with_inertia(centroids.cluster(df, size=10, scale=100, k=7, rounds=4, seed=3)).collect()
    assert sorted((tuple(r) for r in have), key=str) == brute(rows, 10, 100, 7, 4, 3)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i), 1.0]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    have = centroids.with_inertia(centroids.cluster(df, size=2, k=5, rounds=2)).collect()
    assert sorted((tuple(r) for r in have), key=str) == brute(rows, 2, 256, 5, 2, 2)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 3, 300, 1 << 15, 1 << 26]), st.integers(1, 20))
def test_no_bound_is_above_a_distance(seed, large, size):
    rng = np.random.default_rng(seed)
    vectors, centres = rng.integers(-large, large + 1, (50, size)), rng.integers(-large, large + 1, (9, size))
    centres[4] = centres[2]
    number, distance, exact = centroids.nearest(vectors, *centroids.compressed(vectors), centres)
    every = ((vectors[:, None] - centres) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all() and exact <= every.size


def test_screening_prunes():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 40, (40, 64)).astype(np.int64)
    vectors = centres[rng.integers(0, 40, 2000)] + rng.normal(0, 8, (2000, 64)).astype(np.int64)
    assert centroids.nearest(vectors, *centroids.compressed(vectors), centres)[2] < 1.1 * len(vectors)


def test_registered_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    have = op11_centroid_clustering(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in have), key=str) == brute(rows, 64, 256, 40, 5, 2)
