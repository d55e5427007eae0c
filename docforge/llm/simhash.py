"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified Hamming distance, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import LOWER, components, cut, map_arrow, mix64, spread_join, written

#: Members of a block that one step compares; larger blocks are dealt out as pairs of such chunks.
CHUNK = 4096


def shingle_hashes(text: bytes, words: int, step: int = 1 << 14) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the ``words``-word shingles of a UTF-8 text, repeats included, in arrays of at most ``step``.

    A-Z are lower-cased; words are runs without ASCII white space, joined by one space; a shorter text is one shingle.
    """
    tokens = text.translate(LOWER).split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(tokens) < words:
        starts, ends = [0], [len(joined)]
    else:
        starts, ends = starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist()
    digest = xxhash.xxh64_digest
    for i in range(0, len(starts), step):
        raw = b"".join([digest(joined[s:e], 42) for s, e in zip(starts[i : i + step], ends[i : i + step], strict=True)])
        yield np.frombuffer(raw, ">u8")


def fingerprint(text: bytes, words: int = 3, lanes: int = 1) -> tuple[int, ...]:
    """``lanes`` unsigned 64-bit words of the SimHash of a UTF-8 text.

    Features are the hashes of its shingles: lane 0 uses them as they are, the others mix them. A bit is set if it is
    set in more than half of the values. No words: zero.
    """
    n, counts = 0, np.zeros(64 * lanes, np.int64)
    for h in shingle_hashes(text, words):
        n += len(h)
        if lanes > 1:
            own = h.astype(np.uint64)
            h = np.stack([own, *(mix64(own + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)) for k in range(1, lanes))], axis=1).astype(">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(len(h), -1), axis=1).sum(axis=0, dtype=np.int32)
    return tuple(int(x) for x in np.packbits(2 * counts > n).view(">u8"))


def fingerprints(df: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, lanes: int = 1) -> DataFrame:
    """Rows (doc_id, f0, f1, ...): lanes of the fingerprint as signed longs. A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint((t.as_buffer().to_pybytes() if t.is_valid else b""), words, lanes) for t in batch.column(1).cast(pa.large_binary())]
            lane = np.array(values, dtype=np.uint64).reshape(-1, lanes).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(lane[:, k]) for k in range(lanes))], names=["doc_id", *(f"f{k}" for k in range(lanes))])

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(source, run, "doc_id long, " + ", ".join(f"f{k} long" for k in range(lanes)))


def blocks(distance: int, lanes: int = 1, rounds: int = 1, width: int = 20, seed: int = 11) -> list[list[int]]:
    """Masks, as one signed long for each lane, under which close fingerprints are equal.

    One lane: 64 bits in ``distance + 3`` blocks of which any three are kept, about 32 bits of 64 for a distance of 3,
    so that every pair within ``distance`` shares a mask. More lanes: in each round the shuffled bits are split into
    blocks of about ``width`` bits. Pairs with fewer differing bits than a round has blocks are surely found; others with
    the probability that one of all blocks is free of differences.
    """
    rng = np.random.default_rng(seed)
    if lanes == 1:
        parts = np.array_split(np.arange(64), distance + 3)
        chosen = [np.concatenate(c) for c in combinations(parts, 3)]
    else:
        chosen = [p for _ in range(rounds) for p in np.array_split(rng.permutation(64 * lanes), 64 * lanes // width)]
    masks = []
    for bits in chosen:
        lane = [0] * lanes
        for b in bits.tolist():
            lane[b // 64] |= 1 << (b % 64)
        masks.append([m - 2**64 if m >= 2**63 else m for m in lane])
    return masks


def plan(count: int, differing: int, lanes: int, recall: float) -> tuple[int, int]:
    """(width, rounds) of blocks: some 16 of ``count`` random fingerprints share a block, and of pairs that differ in
    ``differing`` bits the share ``recall`` meets in one."""
    width = max(20, int(np.ceil(np.log2(max(2, count)))) - 4)
    free = (1 - differing / (64 * lanes)) ** (64 * lanes / (64 * lanes // width))
    needed = np.log(1 - recall) / np.log(1 - free)
    return width, int(np.ceil(needed / (64 * lanes // width)))


def forest(nodes: np.ndarray, fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a minimum spanning forest of the pairs within ``distance`` (Prim): a pair of any distance is joined by
    edges that are no longer."""
    n = len(nodes)
    best, parent, left, at, edges = np.full(n, 64 * fps.shape[1] + 1), np.zeros(n, np.int64), np.ones(n, bool), 0, []
    for _ in range(n - 1):
        left[at] = False
        near = np.bitwise_count(fps ^ fps[at]).sum(axis=1)
        closer = left & (near < best)
        best[closer], parent[closer] = near[closer], at
        at = int(np.argmin(np.where(left, best, np.iinfo(np.int64).max)))
        if best[at] <= distance:
            edges.append((int(nodes[parent[at]]), int(nodes[at])))
    return edges


def spanning(nodes: np.ndarray, fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs within ``distance``: breadth first over what is not yet reached."""
    edges, left, left_fps = [], nodes, fps
    while len(left) > 1:
        queue, left, left_fps = [(int(left[0]), left_fps[0])], left[1:], left_fps[1:]
        while queue and len(left):
            node, fp = queue.pop()
            near = np.bitwise_count(left_fps ^ fp).sum(axis=1) <= distance
            if near.any():
                edges += [(node, int(x)) for x in left[near]]
                queue += list(zip(left[near].tolist(), left_fps[near], strict=True))
                left, left_fps = left[~near], left_fps[~near]
    return edges


def bipartite(a: tuple, b: tuple, distance: int) -> list[tuple[int, int]]:
    """All links between two chunks matter for connectivity: walk the two-sided graph breadth first."""
    edges = []
    sides = [a, b]
    while len(sides[0][0]) and len(sides[1][0]):
        queue = [(0, int(sides[0][0][0]), sides[0][1][0])]
        sides[0] = (sides[0][0][1:], sides[0][1][1:])
        while queue:
            side, node, fp = queue.pop()
            nodes, fps = sides[1 - side]
            near = np.bitwise_count(fps ^ fp).sum(axis=1) <= distance
            if near.any():
                edges += [(node, int(x)) for x in nodes[near]]
                queue += [(1 - side, n, f) for n, f in zip(nodes[near].tolist(), fps[near], strict=True)]
                sides[1 - side] = (nodes[~near], fps[~near])
    return edges


def _runs(batches: Iterator[pa.RecordBatch], lanes: int, distance: int | None = None) -> Iterator[tuple[int | None, np.ndarray, np.ndarray, int, bool]]:
    """(key, nodes, fingerprints, part, whether more parts follow) of each run of equal keys in sorted batches, in parts
    of at most CHUNK rows. Any part may be short, as a run may begin anywhere in a batch. With ``distance`` runs of two
    rows inside a batch come all at once, under the key None: their pairs within it, one after the other."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    key, part, size = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        block, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        fps = np.stack([batch.column(2 + k).to_numpy(zero_copy_only=False).view(np.uint64) for k in range(lanes)], axis=1)
        change = np.flatnonzero(block[1:] != block[:-1]) + 1
        bounds = np.concatenate([[0], change, [len(block)]])
        first, last = bounds[:-1], bounds[1:]
        edge = (first == 0) | (last == len(block))
        plain = (last - first > 1) | edge  # a single row inside a batch has no partner
        if distance is not None:
            two = (last - first == 2) & ~edge
            plain &= ~two
            at = first[two]
            at = at[np.bitwise_count(fps[at] ^ fps[at + 1]).sum(axis=1) <= distance]
            if len(at):
                pairs = np.stack([at, at + 1], axis=1).ravel()
                yield None, node[pairs], fps[pairs], 0, False
        for s, e in zip(first[plain].tolist(), last[plain].tolist(), strict=True):
            own = int(block[s])
            if own != key:
                if key is not None and size:
                    yield key, *_joined(held), part, False
                key, part, held, size = own, 0, [], 0
            for at in range(s, e, CHUNK):
                to = min(e, at + CHUNK)
                if size + to - at > CHUNK:
                    yield key, *_joined(held), part, True
                    part, held, size = part + 1, [], 0
                held.append((node[at:to], fps[at:to]))
                size += to - at
    if key is not None and size:
        yield key, *_joined(held), part, False


def _joined(held: list) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def links(nodes: DataFrame, distance: int, lanes: int = 1, rounds: int = 1, width: int = 20, shortest: bool = False) -> DataFrame:
    """Edges (a, b) that join all nodes whose fingerprints are within ``distance``; not every pair has an edge.

    ``nodes`` has (node, f0, ...) with distinct fingerprints. A block of any size is compared: one of up to CHUNK members
    in a task, a larger one as pairs of chunks, each a task's group of its own. With ``shortest`` the edges of a block
    are a minimum spanning forest.
    """
    tree = forest if shortest else spanning
    lane = [f"f{k}" for k in range(lanes)]
    masks = blocks(distance, lanes, rounds, width)

    def key(t: int, mask: list[int]) -> Column:
        return F.xxhash64(F.lit(t), *(F.col(c).bitwiseAND(F.lit(m)) for c, m in zip(lane, mask, strict=True)))

    keyed = nodes.select(F.explode(F.array(*(key(t, m) for t, m in enumerate(masks)))).alias("k"), "node", *lane)
    keyed = keyed.repartition("k").sortWithinPartitions("k")
    fields = [("a", pa.int64()), ("b", pa.int64()), ("k", pa.int64()), ("part", pa.int32()), *((c, pa.int64()) for c in lane)]
    ddl = "a long, b long, k long, part int, " + ", ".join(f"{c} long" for c in lane)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for run, ids, fps, part, more in _runs(batches, lanes, distance):
            if run is None:
                rows += [(a, b, None, None, *(None,) * lanes) for a, b in np.sort(ids.reshape(-1, 2), axis=1).tolist()]
            else:
                order = np.argsort(ids, kind="stable")
                rows += [(a, b, None, None, *(None,) * lanes) for a, b in tree(ids[order], fps[order], distance)]
            if part or more:  # one of several chunks
                rows += [(int(i), None, run, part, *(int(x) for x in f)) for i, f in zip(ids, fps.view(np.int64), strict=True)]
            if len(rows) >= 1 << 15:
                yield _batch(rows, fields)
                rows = []
        if rows:
            yield _batch(rows, fields)

    found = cut(map_arrow(keyed, compare, ddl))
    near = found.where("b is not null").select("a", "b")
    members = found.where("b is null").select(F.col("a").alias("node"), "k", "part", *lane)
    most = members.groupBy("k").agg(F.max("part").alias("last")).where("last > 0")
    if most.isEmpty():
        return near
    dealt = members.join(most, "k").select("*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("with")).where("part <> with")
    dealt = dealt.withColumn("x", F.least("part", "with")).withColumn("y", F.greatest("part", "with"))

    def across(_: tuple, group: pa.Table) -> pa.Table:
        sides = []
        for own in (True, False):
            part = group.filter(pc.equal(pc.equal(group["part"], group["x"]), own))
            sides.append((part["node"].to_numpy(), np.stack([part[c].to_numpy().view(np.uint64) for c in lane], axis=1)))
        pairs = forest(*(np.concatenate(p) for p in zip(*sides, strict=True)), distance) if shortest else bipartite(sides[0], sides[1], distance)
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return near.unionByName(dealt.groupBy("k", "x", "y").applyInArrow(across, "a long, b long"))


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def alike(edges: DataFrame, df: DataFrame, text: str, doc_id: str, words: int, similarity: float) -> DataFrame:
    """The ``edges`` (a, b) between documents whose sets of shingles have at least this Jaccard similarity.

    Sets of 64-bit hashes go to the edges by two joins; a document with any number of edges is dealt over salted copies.
    """
    ids = edges.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).join(ids, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for t in batch.column(1).cast(pa.large_binary()):
                parts = list(shingle_hashes(t.as_buffer().to_pybytes() if t.is_valid else b"", words))
                sets.append(np.unique(np.concatenate(parts).astype(np.uint64)).view(np.int64) if parts else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "own"])

    sets = written(map_arrow(source, run, "doc_id long, own array<long>").distinct())
    first = spread_join(edges, sets.select(F.col("doc_id").alias("a"), F.col("own").alias("x")), ["a"])
    both = spread_join(written(first), sets.select(F.col("doc_id").alias("b"), F.col("own").alias("y")), ["b"])
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= similarity * (F.size("x") + F.size("y") - shared)).select("a", "b")


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, distance: int = 3, lanes: int = 1, similarity: float | None = None, recall: float = 0.98) -> DataFrame:
    """Rows (doc_id, f0, ..., component_id), one for each input row.

    Documents link if their fingerprints differ in at most ``distance`` bits; component_id is the smallest doc_id that
    links reach. Exact copies and other texts with equal fingerprints meet in one node first, by a minimum with map-side
    combine, so a hot group costs no comparisons. Null, empty and blank texts have fingerprint zero and link like any
    other. A null doc_id gets the component of its fingerprint's other rows, else null; rows that repeat a doc_id are one
    document. Extra columns are ignored; no rows give no rows.

    With ``similarity`` (which takes more than one lane) fingerprints only propose links: in each block the edges of a
    minimum spanning forest, which are kept if the documents' shingle sets have that Jaccard similarity. Blocks are
    chosen so that of pairs with just that similarity the share ``recall`` meets in one, whatever the number of rows.
    """
    lane = [f"f{k}" for k in range(lanes)]
    prints = cut(fingerprints(df, text, doc_id, words, lanes))
    nodes = prints.groupBy(*lane).agg(F.min("doc_id").alias("node"))
    known = nodes.where("node is not null")
    if similarity is None:
        edges = links(known, distance, lanes)
    else:
        known = cut(known)
        angle = np.arccos(min(1.0, 2 * similarity / (1 + similarity))) / np.pi  # of equally large sets
        width, rounds = plan(known.count(), round(64 * lanes * angle), lanes, recall)
        proposed = links(known, distance, lanes, rounds, width, True)
        edges = alike(cut(proposed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), df, text, doc_id, words, similarity)
    roots = components(edges)
    named = nodes.join(roots, "node", "left").select(*lane, F.coalesce("root", "node").alias("component_id"))
    return prints.join(named, lane).select("doc_id", *lane, "component_id")
