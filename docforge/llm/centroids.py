"""k-means on integer vectors: compressed vectors and segment norms screen centroids, exact distances decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import map_arrow, written

#: Components of a segment, whose norms bound what compression lost.
SEGMENT = 8
#: A code is one of 16 levels; a vector's step is the least power of two at which all its components have one.
LEVELS = 16
#: Components beyond this (after scaling) would let a squared distance outgrow a long.
LARGEST = 1 << 27
#: Vectors screened at once.
CHUNK = 4096


class Clusters(NamedTuple):
    """Rows (vec_id, cluster, distance) and the final centroids, one row of integers each."""

    assigned: DataFrame
    centroids: np.ndarray


def scaled(vector: Column, size: int, scale: int) -> Column:
    """Integers floor(scale * x); null unless there are ``size`` finite components whose integers are in range."""
    ints = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))
    fits = (F.size(vector) == size) & F.forall(vector.cast("array<double>"), lambda x: F.coalesce(F.abs(x * F.lit(float(scale))) < LARGEST, F.lit(False)))
    return F.when(fits, ints)


def ceil_root(squares: np.ndarray) -> np.ndarray:
    """Least integers whose squares reach ``squares``."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64) + 1
    for _ in range(3):  # the float root may be off by one either way
        root -= (root - 1) * (root - 1) >= squares
        root = np.maximum(root, 0)
    return root


def segment_norms(vectors: np.ndarray) -> np.ndarray:
    """Norms of runs of SEGMENT components, rounded up to integers."""
    return ceil_root(np.add.reduceat(vectors * vectors, np.arange(0, vectors.shape[1], SEGMENT), axis=1))


def compressed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, log2 of each vector's step, squared norms, norms of the residuals' segments).

    A code stands for step * code; what is left of a component is below a step.
    """
    shift = np.zeros(len(vectors), np.int64)
    while True:
        codes = vectors >> shift[:, None]
        wide = (codes < -LEVELS // 2).any(axis=1) | (codes >= LEVELS // 2).any(axis=1)
        if not wide.any():
            break
        shift += wide
    centre = (1 << shift) >> 1  # the middle of what shares a code, so that residuals are small and of both signs
    rest = vectors - ((codes << shift[:, None]) + centre[:, None])
    return codes.astype(np.int8), shift.astype(np.int8), (vectors * vectors).sum(axis=1), segment_norms(rest)


def nearest(vectors: np.ndarray, codes: np.ndarray, shift: np.ndarray, squares: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact distances computed); ties go to the smaller number.

    With v = w + r, w from the codes, |v - c|^2 >= |v|^2 + |c|^2 - 2 (w.c + sum over segments of |r_s| |c_s|) by Cauchy and
    Schwarz. All terms are integers and norms are rounded up, so no bound is above the distance. The centroid of least
    bound gets its exact distance first, then those whose bound isn't above that.
    """
    exact_centroids = centroids.astype(np.float64)
    long_codes, shift = codes.astype(np.float64), shift.astype(np.int64)
    products = (long_codes @ exact_centroids.T).astype(np.int64) << shift[:, None]  # below 2**53, so exact
    products += ((1 << shift) >> 1)[:, None] * centroids.sum(axis=1)[None, :]
    slack = norms @ segment_norms(centroids).T
    bounds = squares[:, None] + (centroids * centroids).sum(axis=1)[None, :] - 2 * (products + slack)
    first = bounds.argmin(axis=1)
    best = ((vectors - centroids[first]) ** 2).sum(axis=1)
    rows, others = np.nonzero(bounds <= best[:, None])
    more = others != first[rows]
    rows, others = rows[more], others[more]
    distance = np.empty(len(rows), np.int64)
    for i in range(0, len(rows), CHUNK):
        part = slice(i, i + CHUNK)
        distance[part] = ((vectors[rows[part]] - centroids[others[part]]) ** 2).sum(axis=1)
    # the least (distance, number) of each vector, the first one's included
    rows = np.concatenate([np.arange(len(vectors)), rows])
    others, distance = np.concatenate([first, others]), np.concatenate([best, distance])
    order = np.lexsort((others, distance, rows))
    lead = order[np.concatenate([[True], np.diff(rows[order]) > 0])] if len(order) else order
    return others[lead], distance[lead], len(rows)


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.array([np.frombuffer(v.as_buffer(), kind) for v in column]).reshape(len(column), width) if len(column) else np.zeros((0, width), kind)


def _compress(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1)
            vectors = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), size).astype(np.int64)
            codes, shift, squares, norms = compressed(vectors)
            pairs = (codes[:, ::2].astype(np.uint8) & 15) | (np.pad(codes, ((0, 0), (0, size % 2)))[:, 1::2].astype(np.uint8) << 4)
            blobs = lambda m: pa.array([row.tobytes() for row in m], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), blobs(vectors.astype("<i4")), blobs(pairs.astype(np.uint8)), pa.array(shift), pa.array(squares), blobs(norms.astype("<u4"))],
                names=["vec_id", "vector", "codes", "shift", "squares", "norms"],
            )

    return run


def _unpacked(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    pairs = _matrix(batch.column(2), np.uint8, (size + 1) // 2)
    codes = np.stack([pairs & 15, pairs >> 4], axis=2).reshape(len(pairs), -1)[:, :size].astype(np.int8)
    codes[codes >= LEVELS // 2] -= LEVELS
    segments = -(-size // SEGMENT)
    return (
        _matrix(batch.column(1), "<i4", size).astype(np.int64), codes, batch.column(3).to_numpy(), batch.column(4).to_numpy(), _matrix(batch.column(5), "<u4", segments).astype(np.int64)
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK):
            yield batch.slice(i, CHUNK)


def _sums(table: DataFrame, size: int, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of each centroid's vectors: a row for each centroid from each task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centroids), size), np.int64), np.zeros(len(centroids), np.int64)
        for batch in _slices(batches):
            vectors, *screen = _unpacked(batch, size)
            cluster, _, _ = nearest(vectors, *screen, centroids)
            np.add.at(sums, cluster, vectors)
            counts += np.bincount(cluster, minlength=len(centroids))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = map_arrow(table, run, "cluster long, n long, total array<long>").select("cluster", "n", F.posexplode("total").alias("place", "total"))
    whole = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in whole.orderBy("cluster", "place").collect():  # at most a row for each component of each centroid
        out.setdefault(r.cluster, (r.n, []))[1].append(int(r.total))
    return out


def cluster(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, seed: int = 2) -> Clusters:
    """Lloyd's rounds over integers floor(scale * x), the same on every run and at any number of tasks.

    Kept are vectors of exactly ``size`` components, none of them null or non-finite, nor so large that a distance would
    outgrow a long (2**27 after scaling). Centroids start as the ``k`` of them (all, if fewer) with the smallest SHA-256 of
    ``seed:vec_id``; rows without a vec_id come last there, equal ones by their components. Each round assigns every
    vector to its nearest centroid, ties to the smaller number, and replaces each centroid that has vectors by the floor of
    their mean; then all are assigned once more. Rows that repeat an id are vectors of their own. Extra columns are ignored;
    an empty table gives no rows and no centroids.

    The compressed table is written once and read by each round's map; a round sends k sums a task through one small
    shuffle, so neither the driver nor a task holds more than the centroids and a slice of vectors.
    """
    source = df.select(F.col(vec_id).cast("long").alias("vec_id"), scaled(F.col(vector), size, scale).alias("v")).where("v is not null")
    table = written(map_arrow(source, _compress(size), "vec_id long, vector binary, codes binary, shift byte, squares long, norms binary"))
    start = table.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).asc_nulls_last(), "vec_id", "vector").limit(k)
    centroids = np.array([np.frombuffer(r.vector, "<i4") for r in start.select("vec_id", "vector").collect()], np.int64).reshape(-1, size)
    for _ in range(rounds if len(centroids) else 0):
        centroids = centroids.copy()
        for number, (n, total) in _sums(table, size, centroids).items():
            centroids[number] = [x // n for x in total]
    if not len(centroids):
        return Clusters(table.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            vectors, *screen = _unpacked(batch, size)
            number, distance, _ = nearest(vectors, *screen, centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return Clusters(map_arrow(table, run, "vec_id long, cluster int, distance long"), centroids)


def with_inertia(found: Clusters) -> DataFrame:
    """``found.assigned`` with cluster_inertia, inertia (null where a long can't hold them) and the centroid's digest."""
    spark = found.assigned.sparkSession
    rows = written(found.assigned)
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part"))
    sums = {r.cluster: int(r.part) for r in per.collect()}  # a row for each centroid
    as_long = lambda x: x if x < 1 << 63 else None
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    whole = as_long(sum(sums.values()))
    table = [(n, as_long(part), whole, digests[n]) for n, part in sorted(sums.items())]
    facts = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
