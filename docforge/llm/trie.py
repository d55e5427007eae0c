"""The trie of conversations' prefixes, a level at a time, and what its subtrees would save."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import cut, map_arrow, spread_join, written

#: Ids of members are joined in blocks of this many consecutive numbers before they are hashed.
BLOCK = 1024
EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ["k1", "k2"]
TURN = [*KEY, "words"]


def words_of(text: Column) -> Column:
    """Words of ``text``: runs of characters other than space and 09-0D."""
    return F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")


def _numbered(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, at, k1, k2, words, upto): turns numbered from 0 in their conversation's order, with the words up to each.

    Turns are sorted in ranges over all tasks, so a conversation of any length may span several. Each task numbers its own
    rows; what lies before them in a conversation that began in earlier tasks is added after.
    """
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    keyed = turns.select("conv_id", "turn", F.xxhash64(role, text).alias("k1"), F.xxhash64(F.lit(1), role, text).alias("k2"), words_of(text).alias("words"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "k1", "k2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at, upto = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            conv, words = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            if not len(conv):
                continue
            new = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
            begin = np.flatnonzero(new)
            group = np.cumsum(new)  # 0 goes on with the batch before
            first = np.concatenate([[-at], begin])[group]
            number = np.arange(len(conv)) - first
            sums = np.cumsum(words)
            total = sums - np.concatenate([[-upto], (sums - words)[begin]])[group]
            last, at, upto = conv[-1], int(number[-1]) + 1, int(total[-1])
            arrays = [batch.column(0), pa.array(number), batch.column(2), batch.column(3), batch.column(4), pa.array(total), pa.array(np.full(len(conv), part, np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "at", *TURN, "upto", "part"])

    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(map_arrow(ranged, run, "conv_id long, at long, k1 long, k2 long, words long, upto long, part int"))
    # only a task's first and last conversation can be in others too: at most two rows for each task
    ends = rows.groupBy("part").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("b")).select("part", F.explode(F.array_distinct(F.array("a", "b"))).alias("conv_id"))
    edges = rows.join(F.broadcast(ends), ["part", "conv_id"]).groupBy("conv_id", "part").agg(F.max("at").alias("n"), F.max("upto").alias("w"))
    seen: dict[int, list[tuple[int, int, int]]] = {}
    for r in edges.orderBy("conv_id", "part").collect():
        seen.setdefault(r.conv_id, []).append((r.part, r.n + 1, r.w))
    late = []
    for conv, spans in seen.items():
        n = w = 0
        for part, more, words in spans:
            if n:
                late.append((conv, part, n, w))
            n, w = n + more, w + words
    if late:
        shift = F.broadcast(rows.sparkSession.createDataFrame(late, "conv_id long, part int, n long, w long"))
        rows = rows.join(shift, ["conv_id", "part"], "left").withColumn("at", F.col("at") + F.coalesce("n", F.lit(0))).withColumn("upto", F.col("upto") + F.coalesce("w", F.lit(0)))
    return rows.select("conv_id", "at", *TURN, "upto")


def share_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows (conv_id, depth, k1, k2, words, upto) of rebuilt conversations, rows (conv_id) of all of them).

    The first h turns of a conversation c are those of c - c % ``every``, as far as there are any, h being the CRC-32 of
    c in decimal modulo ``most``; its own turns after its first h follow. ``upto`` counts the words up to a turn.
    """
    own = _numbered(turns)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    base = F.col("conv_id") - F.col("conv_id") % every
    convs = cut(own.select("conv_id").distinct())
    takers = convs.select("conv_id", base.alias("base"), h.alias("h")).where("h > 0 and base <> conv_id")
    heads = own.where((F.col("conv_id") % every == 0) & (F.col("at") < most - 1)).withColumnRenamed("conv_id", "base")
    heads = cut(takers.join(heads, "base").where("at < h").select("conv_id", (F.col("at") + 1).alias("depth"), *TURN, "upto"))
    # what replaces the first h turns may have fewer, and other words: later turns move by the difference
    given = heads.groupBy("conv_id").agg(F.max("depth").alias("got"), F.max("upto").alias("got_words"))
    lost = own.where(f"at < {most - 1}").where(F.col("at") < h).where(base != F.col("conv_id")).groupBy("conv_id").agg(F.max("upto").alias("lost_words"))
    moved = takers.select("conv_id", "h").join(given, "conv_id", "left").join(lost, "conv_id", "left")
    moved = moved.select("conv_id", "h", F.coalesce("got", F.lit(0)).alias("got"), (F.coalesce("got_words", F.lit(0)) - F.coalesce("lost_words", F.lit(0))).alias("more"))
    rest = spread_join(own, moved, ["conv_id"], "left").where("h is null or at >= h")
    rest = rest.select("conv_id", (F.col("at") + 1 + F.coalesce(F.col("got") - F.col("h"), F.lit(0))).alias("depth"), *TURN, (F.col("upto") + F.coalesce("more", F.lit(0))).alias("upto"))
    return written(heads.unionByName(rest)), convs


def _sequences(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (rep, m, n, total, ends): the m conversations of one sequence of n turns, the smallest of them, the sequence's
    words, and the digest of the decimal ids in ascending order.

    A sequence is told by its length and two 64-bit sums over hashes of turns and depths. Ids are joined in blocks; each
    digest then runs over its sequence's sorted blocks, of which a task holds one at a time.
    """
    digest = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "depth", *KEY))
    whole = turns.groupBy("conv_id").agg(F.count("*").alias("n"), digest(1).alias("s1"), digest(2).alias("s2"), F.max("upto").alias("total"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "s1", "s2", "total")]
    told = convs.join(whole, "conv_id", "left").select("conv_id", *zero)
    block = F.floor(F.col("conv_id") / BLOCK).cast("long")
    ids = F.array_sort(F.collect_list("conv_id")).cast("array<string>")  # at most BLOCK of them
    blocks = told.groupBy("n", "s1", "s2", block.alias("block")).agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("m"), F.max("total").alias("total"), F.array_join(ids, ",").alias("ids")
    )
    blocks = blocks.repartition("n", "s1", "s2").sortWithinPartitions("n", "s1", "s2", "block")
    names = ["rep", "m", "n", "total", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        for batch in batches:
            done = []
            for n, s1, s2, rep, m, total, ids in zip(*(batch.column(c).to_pylist() for c in ("n", "s1", "s2", "rep", "m", "total", "ids")), strict=True):
                if (n, s1, s2) != key:
                    if key is not None:
                        done.append((first, many, key[0], words, sha.hexdigest()))
                    key, first, many, words, sha = (n, s1, s2), rep, 0, total, hashlib.sha256()
                elif many:
                    sha.update(b",")
                sha.update(ids.encode())
                many += m
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (first, many, key[0], words, sha.hexdigest())], names=names)

    return written(map_arrow(blocks, run, "rep long, m long, n long, total long, ends string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one for each node.

    ``turns`` has (conv_id, depth from 1, k1, k2: a turn's two hashes, words: its words, upto: all up to it), ``convs`` every conversation.
    Conversations of one sequence of turns are one at first. Then depth by depth: sequences that share their node with
    others are live; they are grouped by (node, next turn), a group is a node of the next depth, named by the smallest
    conversation in it, and a sequence that is alone in its node is followed no further, as all below is one chain. So the
    number of rounds is the depth to which different sequences agree, not that of the longest. Then nodes are joined with
    their children's sums, from the deepest level up. Sequences and nodes of any frequency meet by minima and sums with
    map-side combine and salted joins.
    """
    sequences = _sequences(turns, convs)
    root = sequences.agg(F.min("rep").alias("conv"), F.sum("m").alias("m"), F.count("*").alias("n_seq")).first()
    spark = turns.sparkSession
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    if root.conv is None:
        return spark.createDataFrame([], schema)
    paths = written(spread_join(turns.withColumnRenamed("conv_id", "rep"), sequences.select("rep", "m", "n", "total", "ends"), ["rep"]))
    levels = [spark.createDataFrame([(root.conv, None, root.m, root.n_seq, 0)], "conv long, parent long, n_convs long, n_seq long, words long")]
    alone = [sequences.where(F.lit(root.n_seq == 1)).select("rep", F.lit(0).cast("long").alias("since"), F.lit(None).cast("long").alias("parent"))]
    live = sequences.where(F.lit(root.n_seq > 1)).select("rep", F.lit(root.conv).alias("node"), "n", "ends")
    ended = [live.where("n = 0").select("node", "ends")]
    while root.n_seq > 1 and not live.where(f"n >= {len(levels)}").isEmpty():
        depth = len(levels)
        step = cut(paths.where(F.col("depth") == depth).select("rep", "m", *TURN).join(live, "rep"))
        made = cut(step.groupBy("node", *KEY).agg(F.min("rep").alias("conv"), F.sum("m").alias("n_convs"), F.count("*").alias("n_seq"), F.min("words").alias("words")))
        levels.append(made.select("conv", F.col("node").alias("parent"), "n_convs", "n_seq", "words"))
        alone.append(made.where("n_seq = 1").select(F.col("conv").alias("rep"), F.lit(depth).cast("long").alias("since"), F.col("node").alias("parent")))
        groups = made.where("n_seq > 1").select("node", *KEY, "conv")
        live = cut(spread_join(step, groups, ["node", *KEY]).select("rep", F.col("conv").alias("node"), "n", "ends"))
        ended.append(live.where(f"n = {depth}").select("node", "ends"))
    # chains of lone sequences, whose members are copies of one another
    tops = alone[0]
    for more in alone[1:]:
        tops = tops.unionByName(more)
    tops = cut(tops)
    own = spread_join(paths, tops, ["rep"]).where("depth >= since")
    zero = F.lit(0).cast("long")
    nodes = own.select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("since"), F.col("parent")).otherwise(F.col("rep")).alias("parent_conv_id"), F.col("m").alias("n_convs"),
        F.when(F.col("depth") < F.col("n"), 1).otherwise(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("m") - 1) * (F.col("total") - F.col("upto") + F.col("words"))).alias("saved_tokens"), F.when(F.col("depth") == F.col("n"), F.col("ends")).otherwise(EMPTY).alias("ends_sha256"),
    )
    if root.n_seq == 1:
        top = sequences.select(
            F.col("rep").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("m").alias("n_convs"), F.when(F.col("n") > 0, 1).otherwise(0).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"), ((F.col("m") - 1) * F.col("total")).alias("saved_tokens"), F.when(F.col("n") == 0, F.col("ends")).otherwise(EMPTY).alias("ends_sha256"),
        )
        return nodes.unionByName(top)
    # up from the deepest level: a lone node's sums are in its chain, a live one's come from its children
    tips = nodes.join(tops.select(F.col("rep").alias("conv_id"), F.col("since").alias("depth")), ["conv_id", "depth"])
    tips = cut(tips)
    below = None
    for depth in range(len(levels) - 1, -1, -1):
        sums = tips.where(F.col("depth") == depth + 1).select(F.col("parent_conv_id").alias("conv"), "n_leaves", "saved_tokens")
        if below is not None:
            sums = sums.unionByName(below.select(F.col("parent_conv_id").alias("conv"), "n_leaves", "saved_tokens"))
        sums = sums.groupBy("conv").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        here = levels[depth].where("n_seq > 1").join(sums, "conv").join(ended[depth].withColumnRenamed("node", "conv"), "conv", "left")
        below = cut(here.select(
            F.col("conv").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            (F.col("below") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
        ))
        nodes = nodes.unionByName(below)
    return nodes


def conversation_trie(df: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """``prefix_trie`` of the rebuilt conversations of ``df`` (conv_id, turn, role, text; see share_heads).

    Turns go by turn, null first; a null role or text is empty. Rows of one conversation that repeat a turn follow by a
    hash of role and text. Rows without a conv_id are left out. Roles and texts are told by two 64-bit hashes and not
    shuffled, so texts may be of any length. Extra columns are ignored; an empty table has no nodes.
    """
    turns = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return prefix_trie(*share_heads(turns.where("conv_id is not null"), every, most))
