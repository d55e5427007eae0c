"""Nearest neighbours by inner product: NN-descent over landmarks, greedy walks of their graph, products of the cells reached."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docforge.llm.common import map_arrow, mix64, written

#: Of the graph: neighbours of a node, reverse neighbours that meet in a round, random trees that make the first graph
#: along with one random order, members of a leaf, rounds at most; a round that changes fewer of all edges ends the descent.
DEGREE, REVERSE, SPLITS, CELL, ROUNDS, LEAST_CHANGE = 32, 32, 4, 256, 9, 0.005
#: Landmarks are a sample of the nodes of one length: PER_ROOT for the root of their number, MOST_LANDMARKS and LANDMARK_BYTES
#: at most. Nodes fewer than ALONE are one cell.
PER_ROOT, MOST_LANDMARKS, LANDMARK_BYTES, ALONE = 4, 8192, 1 << 25, 64
#: Landmarks that a walk starts from.
ENTRIES = 256
#: Queries held against all nodes to find how many cells the others need, and the recall that these must have there.
TRIED, RECALL = 256, 0.95
#: A block's rows: BLOCK times the root of all, MOST_ROWS and BLOCK_BYTES (as float32) at most.
BLOCK, MOST_ROWS, BLOCK_BYTES = 192, 1 << 19, 1 << 27
#: Of a block: shares of a cell's rows that are compared first; columns and scores of one product.
PASSES, COLS, TILE = (1 / 16,), 4096, 1 << 19
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
LOW = np.uint64(0xFFFFF)


def clean_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (vec_id, x: array of float or double) that take part: one for each id."""
    x = F.col(embedding)
    if df.schema[embedding].dataType not in (T.ArrayType(T.FloatType(), False), T.ArrayType(T.FloatType(), True)):
        x = x.cast("array<double>")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null")
    finite = ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(finite & F.exists("x", lambda v: v != 0))
    if rows.groupBy("vec_id").count().where("count > 1").isEmpty():  # spares moving the vectors
        return rows
    return rows.groupBy("vec_id").agg(F.min("x").alias("x"))


def packed(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, x, digest): the vector's bytes, and two hashes that are alike for equal vectors."""
    kind = "f4" if vectors.schema["x"].dataType.elementType == T.FloatType() else "f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)  # no negative zeros
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False))]) * x.itemsize
            values = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["vec_id", "x"])

    return map_arrow(vectors, run, "vec_id long, x binary").withColumn("digest", F.unhex(F.substring(F.sha2("x", 256), 1, 32)))


def unpack(x: pa.Array, kind: str) -> np.ndarray:
    """The vectors of values of one length, in their own type."""
    x = x.cast(pa.large_binary())
    ends = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1]
    return np.frombuffer(x.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(x), -1)


def alike(sizes: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(size, rows) for each size; vectors of different lengths are never compared."""
    sizes = sizes.to_numpy(zero_copy_only=False)
    for n in np.unique(sizes):
        yield int(n), np.flatnonzero(sizes == n)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each run of equal keys starts, the place of each key in its run)."""
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return start, np.arange(len(keys)) - np.repeat(start, np.diff(np.append(start, len(keys))))


class Graph:
    """About the DEGREE nearest landmarks of each landmark, by NN-descent, and walks over them.

    The first lists come from the leaves of random trees and of a random order, so that a tight group also gets to know
    landmarks far from it. In each round the neighbours and some reverse neighbours of a landmark meet, so that neighbours of
    neighbours get to know each other, unless both were there before. A list is a row of sorted keys: owner (20 bits),
    score (23, the greatest first), neighbour (20), fresh (1).
    """

    def __init__(self, x: np.ndarray) -> None:
        self.x = x / np.linalg.norm(x, axis=1, keepdims=True)
        self.n = len(x)
        self.lists = np.full((self.n, DEGREE), NONE, np.uint64)
        self.least = np.full(self.n, -np.inf, np.float32)
        rng = np.random.default_rng(23)
        for k in range(SPLITS + 1):
            leaves = np.full(-(-self.n // CELL) * CELL, -1, np.int64)
            leaves[: self.n] = self.leaves(rng) if k < SPLITS else rng.permutation(self.n)
            self.meet(leaves.reshape(-1, CELL), np.ones((len(leaves) // CELL, CELL), bool), 16)
        for seed in range(ROUNDS):
            members, fresh = self.around(seed)
            self.lists = np.where(self.lists == NONE, NONE, self.lists & ~np.uint64(1))
            go = fresh.any(axis=1)
            self.meet(members[go], fresh[go], 256)
            known = self.lists != NONE
            if (self.lists[known] & np.uint64(1)).sum() <= LEAST_CHANGE * known.sum():
                break
        links = self.around(99)[0]
        self.links = np.where(links < 0, np.arange(self.n)[:, None], links).astype(np.int32)  # none: a link to itself
        del self.lists, self.least

    def leaves(self, rng: np.random.Generator) -> np.ndarray:
        """The landmarks in the order of a tree that halves each cell by a random direction."""
        cell = np.zeros(self.n, np.int64)
        while self.n >> int(cell.max()).bit_length() > CELL:
            order = np.lexsort((self.x @ rng.standard_normal(self.x.shape[1]).astype(np.float32), cell))
            start, place = runs(cell[order])
            count = np.diff(np.append(start, self.n))
            cell[order] = 2 * cell[order] + (place >= np.repeat((count + 1) // 2, count))
        return np.argsort(cell, kind="stable")

    def meet(self, members: np.ndarray, fresh: np.ndarray, step: int) -> None:
        """Members of one row (-1: none) get to know each other, where one is fresh and nearer than what they have."""
        held, size, width = [], 0, members.shape[1]
        for a in range(0, len(members), step):
            there = members[a : a + step] >= 0
            m = np.where(there, members[a : a + step], 0)
            x = self.x[m]
            s = x @ x.transpose(0, 2, 1)
            new = fresh[a : a + step]
            good = (s > np.where(there, self.least[m], np.inf)[:, :, None]) & there[:, None, :] & (new[:, :, None] | new[:, None, :])
            at = np.flatnonzero(good & (m[:, :, None] != m[:, None, :]))
            v, u = m.ravel()[at // width], m.ravel()[at // (width * width) * width + at % width]
            low, high = np.minimum(v, u), np.maximum(v, u)
            near = (np.clip(1 - self.pairs(low, high), 0, 2) * (1 << 21)).astype(np.uint64)  # one score for both, in any meeting
            held.append(v.astype(np.uint64) << np.uint64(44) | near << np.uint64(21) | u.astype(np.uint64) << np.uint64(1) | np.uint64(1))
            size += len(at)
            if size > 1 << 20 or a + step >= len(members):
                self.keep(np.concatenate(held))
                held, size = [], 0

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), np.float32)
        for i in range(0, len(a), 1 << 14):
            out[i : i + (1 << 14)] = np.einsum("ij,ij->i", self.x[a[i : i + (1 << 14)]], self.x[b[i : i + (1 << 14)]])
        return out

    def keep(self, keys: np.ndarray) -> None:
        """The lists with ``keys`` put in; an edge known before stays as it was."""
        hit = np.unique((keys >> np.uint64(44)).astype(np.int64))
        keys = np.concatenate([keys, self.lists[hit][self.lists[hit] != NONE]])
        keys.sort()
        keys = keys[runs(keys >> np.uint64(1))[0]]
        v = (keys >> np.uint64(44)).astype(np.int64)
        place = runs(v)[1]
        v, keys, place = v[place < DEGREE], keys[place < DEGREE], place[place < DEGREE]
        self.lists[hit] = NONE
        self.lists[v, place] = keys
        last = self.lists[hit, DEGREE - 1]
        self.least[hit] = np.where(last == NONE, -np.inf, 1 - ((last >> np.uint64(21)) & np.uint64(0x7FFFFF)).astype(np.float32) / (1 << 21))

    def around(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """(members, fresh): a landmark's neighbours, and of its reverse neighbours those that a hash puts first; -1 for none."""
        known = self.lists != NONE
        u = np.where(known, (self.lists >> np.uint64(1)) & LOW, 0).astype(np.int64)
        fresh = known & ((self.lists & np.uint64(1)) == 1)
        v = np.nonzero(known)[0]
        order = np.lexsort((mix64(v.astype(np.uint64) + np.uint64(seed << 32)), u[known]))
        to = u[known][order]
        place = runs(to)[1]
        ok = place < REVERSE
        back, new = np.full((self.n, REVERSE), -1, np.int64), np.zeros((self.n, REVERSE), bool)
        back[to[ok], place[ok]] = v[order][ok]
        new[to[ok], place[ok]] = fresh[known][order][ok]
        return np.concatenate([np.where(known, u, -1), back], axis=1), np.concatenate([fresh, new], axis=1)

    def walk(self, q: np.ndarray, beam: int) -> np.ndarray:
        """Flags (query, landmark) of the ``beam`` best landmarks that a greedy walk from a fixed few finds for each query.

        Of the candidates kept for a query, those not expanded yet give their neighbours, until all are expanded: a dropped
        one is worse than all that are kept, so it never comes back and every walk ends. A product is taken once.
        """
        score, fresh = np.full((len(q), self.n), -np.inf, np.float32), np.zeros((len(q), self.n), bool)
        entry = np.arange(0, self.n, max(1, self.n // ENTRIES))
        score[:, entry], fresh[:, entry] = q @ self.x[entry].T, True
        act = np.arange(len(q))
        while len(act):
            go = fresh[act] & (score[act] >= self.limit(score[act], beam))
            row, at = np.nonzero(go)
            fresh[act] &= ~go
            to = self.links[at]
            new = np.zeros(go.shape, bool)
            new.ravel()[to + row[:, None] * self.n] = True
            new &= np.isneginf(score[act])
            row, to = np.nonzero(new)
            bounds, x, found = np.searchsorted(row, np.arange(len(act) + 1)).tolist(), self.x[to], np.empty(len(to), np.float32)
            for r, i, j in zip(act.tolist(), bounds[:-1], bounds[1:], strict=True):
                found[i:j] = x[i:j] @ q[r]
            score[act[row], to], fresh[act[row], to] = found, True
            act = act[np.isin(np.arange(len(act)), row)]
        return np.isfinite(score) & (score >= self.limit(score, beam))

    def limit(self, score: np.ndarray, beam: int) -> np.ndarray:
        return np.partition(score, self.n - beam, axis=1)[:, self.n - beam, None] if beam < self.n else np.full((len(score), 1), -np.inf, np.float32)

    def walks(self, q: np.ndarray, beam: int, most: int = 1 << 17) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, flags) of runs of queries."""
        step = int(np.clip(most // self.n, 8, 256))
        for a in range(0, len(q), step):
            yield a, self.walk(np.ascontiguousarray(q[a : a + step], np.float32), beam)


def dropped(table: DataFrame) -> None:
    """Deletes a table that ``written`` made and nothing reads any more."""
    sc = table.sparkSession.sparkContext
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def loads(n: int, spark: SparkSession) -> list[int]:
    """A key for each of ``n`` partitions, which Spark's hash sends there."""
    there = spark.range(64 * n + 1024).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).groupBy("p").agg(F.min("id").alias("id"))
    own = {r.p: r.id for r in there.collect()}
    return [own.get(p, p) for p in range(n)]


class Index:
    """Cells of landmarks for each length of vectors, in bytes; cells are numbered through."""

    def __init__(self, graphs: dict[int, Graph | None], kind: str) -> None:
        self.graphs, self.kind, self.first, self.probes = graphs, kind, {}, dict.fromkeys(graphs, 1)
        self.cells = 0
        for size, graph in sorted(graphs.items()):
            self.first[size] = self.cells
            self.cells += graph.n if graph else 1

    def deal(self, counts: dict[int, int], most: int) -> int:
        """Deals cells to blocks of about ``most`` rows; a large cell goes in pieces, by a hash of the row."""
        blocks = max(1, -(-sum(counts.values()) // most))
        self.count = np.zeros(self.cells, np.int64)
        self.count[list(counts)] = list(counts.values())
        self.pieces = np.maximum(1, -(-self.count * 4 // most))
        self.start = np.concatenate([[0], np.cumsum(self.pieces)])
        self.block = np.zeros(self.start[-1], np.int64)
        held = [(0, b) for b in range(blocks)]
        for cell in np.argsort(-(self.count / self.pieces), kind="stable").tolist():
            for piece in range(self.start[cell], self.start[cell + 1]):
                size, b = held[0]
                self.block[piece] = b
                heapq.heapreplace(held, (size + int(self.count[cell] // self.pieces[cell]), b))
        return blocks

    def reached(self, size: int, q: np.ndarray, least: int) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, cells of each row) whose rows are compared with a query; all where the walk's hold fewer than ``least``."""
        graph, first = self.graphs[size], self.first[size]
        every = np.arange(first, first + (graph.n if graph else 1))
        if len(every) <= self.probes[size]:
            yield 0, [every] * len(q)
            return
        for a, walk in graph.walks(q, self.probes[size]):
            yield a, [cells if self.count[cells := np.flatnonzero(w) + first].sum() >= least else every for w in walk]


def fitted(nodes: DataFrame, kind: str) -> Index:
    """Landmarks drawn by a hash of the id, of each length in proportion to the root of its number, and their graphs."""
    size = F.octet_length("x").alias("size")
    counts = {r["size"]: r["count"] for r in nodes.groupBy(size).count().collect()}
    item, total = np.dtype(kind).itemsize, sum(s * n for s, n in counts.items())
    want = {s: min(int(PER_ROOT * n**0.5), MOST_LANDMARKS, LANDMARK_BYTES * n * item // (4 * total)) if n >= ALONE else 0 for s, n in counts.items()}
    graphs: dict[int, Graph | None] = dict.fromkeys(counts)
    shares = [(s, w / counts[s]) for s, w in want.items() if w > 1]
    if shares:
        shares = nodes.sparkSession.createDataFrame(shares, "size int, share double")
        draw = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
        drawn = nodes.withColumn("size", size).join(F.broadcast(shares), "size").where(draw < F.col("share")).select("size", "vec_id", "x").collect()
        by: dict[int, list] = {}
        for r in sorted(drawn, key=lambda r: (r["size"], r.vec_id)):
            by.setdefault(r["size"], []).append(np.frombuffer(r.x, kind))
        graphs |= {s: Graph(np.stack(x)) for s, x in by.items() if len(x) > 1}
    return Index(graphs, kind)


def placed(nodes: DataFrame, index: Index) -> DataFrame:
    """Rows (vec_id, x, cell): the cell of the landmark in whose direction a vector goes furthest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            for size, rows in alike(pc.binary_length(batch.column(1))):
                cell[rows] = index.first[size]
                if graph := index.graphs[size]:
                    x = unpack(batch.column(1).take(pa.array(rows)), index.kind)
                    for a in range(0, len(x), 128):
                        cell[rows[a : a + 128]] += (x[a : a + 128].astype(np.float32) @ graph.x.T).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell)], names=["vec_id", "x", "cell"])

    return map_arrow(nodes.select("vec_id", "x"), run, "vec_id long, x binary, cell int")


def tried(queries: DataFrame, rows: DataFrame, index: Index, k: int) -> None:
    """Sets how many cells a query reaches, by the nearest of some TRIED queries of each length among all rows."""
    size = F.octet_length("x").alias("size")
    asked = {r["size"]: r["count"] for r in queries.groupBy(size).count().collect() if index.graphs[r["size"]]}
    if not asked:
        return
    shares = queries.sparkSession.createDataFrame([(s, TRIED / n) for s, n in asked.items()], "size int, share double")
    draw = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30)) / (1 << 30)
    drawn = queries.withColumn("size", size).join(F.broadcast(shares), "size").where(draw < F.col("share")).select("size", "vec_id", "x").collect()
    tries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for s in {r["size"] for r in drawn}:
        own = [r for r in drawn if r["size"] == s]
        tries[s] = np.array([r.vec_id for r in own]), np.stack([np.frombuffer(r.x, index.kind) for r in own]).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {s: (np.full((len(ids), k), -np.inf, np.float32), np.zeros((len(ids), k), np.int32)) for s, (ids, _) in tries.items()}
        for batch in batches:
            for s, at in alike(pc.binary_length(batch.column(1))):
                if s in tries:
                    own = batch.take(pa.array(at))
                    ids, q = tries[s]
                    score = q @ unpack(own.column(1), index.kind).astype(np.float32).T
                    score[ids[:, None] == own.column(0).to_numpy(zero_copy_only=False)] = -np.inf
                    score = np.concatenate([best[s][0], score], axis=1)
                    cell = np.concatenate([best[s][1], np.broadcast_to(own.column(2).to_numpy(zero_copy_only=False), (len(q), len(at)))], axis=1)
                    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    best[s] = np.take_along_axis(score, top, axis=1), np.take_along_axis(cell, top, axis=1)
        for s, (score, cell) in best.items():
            t, j = np.nonzero(np.isfinite(score))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), s, np.int32)), pa.array(t.astype(np.int32)), pa.array(cell[t, j]), pa.array(score[t, j])], names=["size", "t", "cell", "s"])

    near = map_arrow(rows, run, "size int, t int, cell int, s float")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("size", "t").orderBy(F.desc("s"), "cell"))).where(F.col("n") <= k).select("size", "t", "cell").collect()
    for s, (_, q) in tries.items():
        graph = index.graphs[s]
        t, cell = (np.array([r[c] for r in near if r["size"] == s], np.int64) for c in ("t", "cell"))
        if not len(t):
            continue
        score = q @ graph.x.T
        ranks = (score[t] > score[t, cell - index.first[s]][:, None]).sum(axis=1)
        probes = int(np.quantile(ranks, RECALL)) + 1
        while probes < graph.n:
            seen = np.concatenate([walk for _, walk in graph.walks(q, probes)])
            if seen[t, cell - index.first[s]].mean() >= RECALL:
                break
            probes = int(probes * 1.1) + 1
        index.probes[s] = probes


def gathered(rows: DataFrame, queries: DataFrame, index: Index, keys: list[int], k: int) -> DataFrame:
    """Rows (block, asks, cell, id, x, cells): each row in its block, each query in the blocks that hold cells it reaches."""
    own = np.array(keys)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column(2).to_numpy(zero_copy_only=False)
            piece = mix64(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) % index.pieces[cell].astype(np.uint64)
            block = own[index.block[index.start[cell] + piece.astype(np.int64)]]
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(np.zeros(len(cell), bool)), batch.column(2), batch.column(0), batch.column(1), pa.nulls(len(cell), pa.binary())], names=names)

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at in alike(pc.binary_length(batch.column(1))):
                part = batch.take(pa.array(at))
                step = max(1, (1 << 23) // (size * len(own)))
                for a, reached in index.reached(size, unpack(part.column(1), index.kind), k + 1):
                    for i in range(0, len(reached), step):
                        some = reached[i : i + step]
                        row, cell = np.repeat(np.arange(len(some)), [len(c) for c in some]), np.concatenate(some)
                        pieces = index.pieces[cell]
                        row, cell, place = np.repeat(row, pieces), np.repeat(cell, pieces), np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                        to = row * len(own) + index.block[index.start[cell] + place]
                        order = np.argsort(to, kind="stable")  # of a block, cells in order
                        to, cell = to[order], cell[order]
                        once = np.concatenate([[True], (to[1:] != to[:-1]) | (cell[1:] != cell[:-1])])
                        to, cell = to[once], cell[once].astype(np.int32)
                        start = runs(to)[0]
                        ends = (np.append(start, len(to)) * 4).astype(np.int32)
                        cells = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(cell.tobytes())])
                        who = part.take(pa.array(a + i + to[start] // len(own)))
                        yield pa.RecordBatch.from_arrays([pa.array(own[to[start] % len(own)]), pa.array(np.ones(len(start), bool)), pa.array(np.zeros(len(start), np.int32)), who.column(0), who.column(1), cells], names=names)

    names = ["block", "asks", "cell", "id", "x", "cells"]
    schema = "block long, asks boolean, cell int, id long, x binary, cells binary"
    return map_arrow(rows, nodes, schema).unionByName(map_arrow(queries, asking, schema))


class Block:
    """Rows of some cells, and the ``most`` nearest of them for queries that reach these."""

    def __init__(self, parts: list[tuple], most: int, kind: str) -> None:
        self.most = most
        self.by: dict[int, tuple] = {}
        for size in sorted({p[0] for p in parts}):
            own = [p for p in parts if p[0] == size]
            cell, ids = (np.concatenate([p[i] for p in own]) for i in (1, 2))
            x, n = np.empty((len(ids), size // np.dtype(kind).itemsize), kind), 0
            for p in own:
                x[n : n + len(p[3])] = p[3]
                n += len(p[3])
                p[3].resize(0, refcheck=False)
            rank = np.empty(len(ids), np.int64)
            rank[np.argsort(ids)] = np.arange(len(ids))
            start = runs(cell)[0]
            self.by[size] = ids, x, x.astype(np.float32, copy=False), rank, np.argsort(ids), dict(zip(cell[start].tolist(), zip(start.tolist(), np.append(start, len(cell))[1:].tolist(), strict=True), strict=True))

    def nearest(self, size: int, mine: np.ndarray, cells: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``mine``, score, id), for each row the nearest first; 8192 rows at most. A key is row, score, rank of the id."""
        ids, exact, x, rank, ranked, where = self.by[size]
        q, slack = mine.astype(np.float32), self.most + 8
        limit = np.full(len(q), -np.inf, np.float32)
        row, cell = np.repeat(np.arange(len(q)), [len(c) for c in cells]), np.concatenate(cells)
        order = np.argsort(cell, kind="stable")
        row, cell = row[order], cell[order]
        start = runs(cell)[0]
        held, count, kept = [], 0, np.zeros(0, np.uint64)

        def settle() -> None:
            nonlocal held, count, kept
            keys = np.concatenate([kept, *held])
            keys.sort()
            own, place = (keys >> np.uint64(51)).astype(np.int64), runs(keys >> np.uint64(51))[1]
            kept = keys[place < slack]
            last = place == slack - 1
            limit[own[last]] = score_of(keys[last])
            held, count = [], 0

        for begin, end in zip((0, *PASSES), (*PASSES, 1.0), strict=True):  # a few rows of each cell first, for limits that spare the others
            for i, j in zip(start.tolist(), np.append(start, len(cell))[1:].tolist(), strict=True):
                low, high = where.get(int(cell[i]), (0, 0))  # a piece of a cell may be empty
                low, high = low + int(np.ceil((high - low) * begin)), low + int(np.ceil((high - low) * end))
                for a in range(low, high, COLS):
                    b = min(high, a + COLS)
                    step = max(1, TILE // (b - a))
                    for r in range(i, j, step):
                        who = row[r : min(j, r + step)]
                        s = q[who] @ x[a:b].T
                        at = true_at((s >= limit[who][:, None]).ravel())
                        if len(at):
                            held.append(who[at // (b - a)].astype(np.uint64) << np.uint64(51) | key_of(s.ravel()[at]) | rank[a + at % (b - a)].astype(np.uint64))
                            count += len(at)
                            if count > 1 << 19:
                                settle()
            settle()
        row, at = (kept >> np.uint64(51)).astype(np.int64), ranked[(kept & LOW).astype(np.int64)]
        score = np.zeros(len(row))
        for a in range(0, len(row), 1 << 14):
            mine_, theirs = mine[row[a : a + (1 << 14)]].astype(np.float64), exact[at[a : a + (1 << 14)]].astype(np.float64)
            for c in range(mine.shape[1]):  # one after the other, as a sum in SQL
                score[a : a + (1 << 14)] += mine_[:, c] * theirs[:, c]
        order = np.lexsort((ids[at], -score, row))
        row, at, score = row[order], at[order], score[order]
        ok = runs(row)[1] < self.most
        return row[ok], score[ok], ids[at[ok]]


def true_at(flags: np.ndarray) -> np.ndarray:
    """Where few flags are set, by eight at a time."""
    whole = len(flags) & ~7
    words = np.flatnonzero(flags[:whole].view(np.uint64))
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flags[at]], whole + np.flatnonzero(flags[whole:])])


def key_of(s: np.ndarray) -> np.ndarray:
    """31 bits of a score above 20 free ones: the greater the score, the smaller."""
    b = (s + np.float32(0)).view(np.uint32)
    return (np.where(b >> np.uint32(31), b, ~b & np.uint32(0x7FFFFFFF)) >> np.uint32(1)).astype(np.uint64) << np.uint64(20)


def score_of(keys: np.ndarray) -> np.ndarray:
    """A score no greater than that of a key."""
    b = ((keys >> np.uint64(20)) & np.uint64(0x7FFFFFFF)).astype(np.uint32) << np.uint32(1) | np.uint32(1)
    return np.where(b >> np.uint32(31), b, ~b & np.uint32(0x7FFFFFFF)).view(np.float32)


def compared(dealt: DataFrame, kind: str, most: int) -> DataFrame:
    """Rows (q, found): of each block the ``most`` nearest of a query, as pairs of a score and an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        block, at = None, None
        for batch in batches:
            key, asks = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            start = runs(key * 2 + asks)[0].tolist()
            for i, j in zip(start, [*start[1:], batch.num_rows], strict=True):
                if key[i] != at:
                    parts, block, at = [], None, key[i]
                for size, rows in alike(pc.binary_length(batch.column(4).slice(i, j - i))):
                    own = batch.take(pa.array(i + rows))
                    if not asks[i]:
                        parts.append((size, own.column(2).to_numpy(zero_copy_only=False).copy(), own.column(3).to_numpy(zero_copy_only=False).copy(), unpack(own.column(4), kind).copy()))
                        continue
                    block = block or Block(parts, most, kind)
                    if size not in block.by:
                        continue
                    step = -(-len(rows) // -(-len(rows) // 8192))
                    for a in range(0, len(rows), step):
                        some = own.slice(a, step)
                        row, score, ids = block.nearest(size, unpack(some.column(4), kind), [np.frombuffer(c.as_buffer(), np.int32) for c in some.column(5)])
                        start_ = runs(row)[0]
                        pairs = np.empty(len(row), [("s", "<f8"), ("w", "<i8")])
                        pairs["s"], pairs["w"] = score, ids
                        ends = (np.append(start_, len(row)) * 16).astype(np.int32)
                        found = pa.Array.from_buffers(pa.binary(), len(start_), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(pairs.tobytes())])
                        yield pa.RecordBatch.from_arrays([some.column(3).take(pa.array(row[start_])), found], names=["q", "found"])

    return map_arrow(dealt, run, "q long, found binary")


def best_of(found: DataFrame, most: int) -> DataFrame:
    """Rows (q, w, score): the ``most`` nearest of a query over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def top(rows: pa.Table) -> pa.RecordBatch:
            q, values = rows.column(0).to_numpy(), [v.as_buffer() for v in rows.column(1)]
            pairs = np.frombuffer(b"".join(values), [("s", "<f8"), ("w", "<i8")])
            q = np.repeat(q, [v.size // 16 for v in values])
            order = np.lexsort((pairs["w"], -pairs["s"], q))
            order = order[runs(q[order])[1] < most]
            return pa.RecordBatch.from_arrays([pa.array(q[order]), pa.array(pairs["w"][order]), pa.array(pairs["s"][order])], names=["q", "w", "score"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            q = rows.column(0).to_numpy()
            last = int(np.searchsorted(q, q[-1])) if len(q) else 0
            if last:
                yield top(rows.slice(0, last))
            rest = rows.slice(last)
        if rest is not None and rest.num_rows:
            yield top(rest)

    return map_arrow(found.repartition("q").sortWithinPartitions("q"), run, "q long, w long, score double")


def search(df: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest found of each vector whose id is divisible by ``every``.

    The score is the inner product of the original vectors in double precision; nearest first, ties to the smaller id; a
    query is not its own neighbour. Null vectors, vectors without a component other than zero or with a null or
    non-finite one and rows with a null id take no part; a query's candidates are the vectors of its length, as others
    have no inner product with it. Rows that repeat an id count once, with the smallest vector. Equal vectors are one
    node of the index, whose smallest ids are put in for it at the end. An empty table gives no rows.

    Landmarks, a bounded sample of the vectors, are linked by NN-descent; each vector joins the cell of its landmark. A query
    walks to the best landmarks and is held against all vectors of their cells. Their number is the one at which a sample
    of queries finds RECALL of its nearest among all vectors.
    """
    clean = clean_vectors(df, vec_id, embedding)
    kind = "f4" if clean.schema["x"].dataType.elementType == T.FloatType() else "f8"
    vectors = written(packed(clean))
    repeated = vectors.groupBy("digest").agg(F.min("vec_id").alias("w"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = written(vectors.select("vec_id", "digest").join(repeated, "digest").select("w", "vec_id"))
    nodes, asks = vectors, F.pmod("vec_id", F.lit(every)) == 0
    none = copies.isEmpty()
    if not none:
        nodes = nodes.join(copies.where("vec_id <> w").select("vec_id"), "vec_id", "left_anti")
    index = fitted(nodes, kind)
    rows = written(placed(nodes, index))
    dropped(vectors)
    asked = rows.where(asks).select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("q"))
    asked = asked.unionByName(copies.where(asks & (F.col("vec_id") != F.col("w"))).select(F.col("vec_id").alias("query_id"), F.col("w").alias("q")))
    queries = rows.where(asks) if none else rows.join(asked, F.col("vec_id") == F.col("q"), "left_semi")
    counts = {r.cell: r["count"] for r in rows.groupBy("cell").count().collect()}
    n, width = sum(counts.values()), max(index.graphs, default=8) // np.dtype(kind).itemsize
    blocks = index.deal(counts, int(min(max(BLOCK * n**0.5, 1 << 14), MOST_ROWS, max(1024, BLOCK_BYTES // (4 * max(1, width))))))
    tried(queries, rows, index, k)
    dealt = gathered(rows, queries, index, loads(blocks, df.sparkSession), k).repartition(blocks, "block").sortWithinPartitions("block", "asks", "cell")
    top = best_of(compared(dealt, kind, k + 1), k + 1)
    first = copies.withColumn("n", F.row_number().over(Window.partitionBy("w").orderBy("vec_id"))).where(F.col("n") <= k + 1).drop("n")
    answer = asked.join(top, "q").join(first, "w", "left").withColumn("vec_id", F.coalesce("vec_id", "w")).where("vec_id <> query_id")
    answer = answer.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return answer.select("query_id", "rank", "vec_id", "score")
