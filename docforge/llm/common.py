"""Helpers shared by the corpus operators: Arrow batches, word hashing, checkpoints, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docforge.session import ship

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bits of the largest sketch that is broadcast: a million words.
SKETCH_BITS = 1 << 26
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The cluster's shared folder; a temporary folder only where none is set and all runs on one machine (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="docforge-"))


def widened(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` followed by the fields of ``ddl``."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so that lost executors cost no recomputation of the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a Parquet table in the shared checkpoint folder: smaller for many rows. It stays with the folder."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def spread_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", least: int = 10_000) -> DataFrame:
    """Equi-join in which one key may hold any share of ``left``, whose keys are not null; ``left`` is best a cut one.

    Keys with more than ``least`` rows and more than a thousandth of all, so a thousand at most, are broadcast; their
    rows on the left are dealt by a hash over salted copies of the right ones.
    """
    most = max(least, left.count() // 1000)
    hot = left.groupBy(*on).count().where(F.col("count") > most).select(*on, F.ceil(F.col("count") / most).cast("int").alias("_salts"))
    hot = cut(hot)
    if hot.isEmpty():
        return left.join(right, on, how)
    hashed = F.xxhash64(*(c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind))
    dealt = left.join(F.broadcast(hot), on, "left").withColumn("_salt", F.coalesce(F.pmod(hashed, F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    copies = right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_chunks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``most`` bytes; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, n)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(keys: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(words of a bit map of hashed keys, its bits): 16 bits a key, SKETCH_BITS at most, so it is safe to broadcast."""
    bits = 1 << 16
    wanted = 16 * keys.count()
    while bits < min(wanted, SKETCH_BITS):
        bits *= 2
    bit = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftrightunsigned(bit, 6).alias("_slot"), bit.bitwiseAND(F.lit(63)).cast("int").alias("_bit"))
    return words.groupBy("_slot").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_word")), bits


def maybe_in(df: DataFrame, column: str, words: DataFrame, bits: int) -> DataFrame:
    """Rows whose key may be in the sketch: all that are, and few others unless the sketch is full."""
    bit = F.col(column).bitwiseAND(F.lit(bits - 1))
    near = df.withColumn("_slot", F.shiftrightunsigned(bit, 6)).withColumn("_bit", bit.bitwiseAND(F.lit(63)).cast("int"))
    return near.join(F.broadcast(words), "_slot").where("getbit(_word, _bit) = 1").drop("_slot", "_bit", "_word")


def parted(df: DataFrame, column: str, words: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the sketch, rows whose key is surely not), so that only the first need a join."""
    bit = F.coalesce(F.col(column), F.lit(0)).bitwiseAND(F.lit(bits - 1))
    near = df.withColumn("_slot", F.shiftrightunsigned(bit, 6)).withColumn("_bit", bit.bitwiseAND(F.lit(63)).cast("int"))
    near = near.join(F.broadcast(words), "_slot", "left")
    inside = F.coalesce(F.expr("getbit(_word, _bit) = 1"), F.lit(False))
    return near.where(inside).select(*df.columns), near.where(~inside).select(*df.columns)


class WordHasher:
    """Word starts, ends and 64-bit hashes of whole byte chunks without a Python loop over words.

    The hash of a word is a polynomial over random byte values, taken from prefix sums modulo 2**64.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, separators: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.sep = separators
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        base, inverse = np.full(n, self.BASE, np.uint64), np.full(n, pow(self.BASE, -1, 2**64), np.uint64)
        base[0] = inverse[0] = 1
        self.power, self.inverse = np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, hashes, first word of each text, with the total at the end)."""
        n = len(data)
        if n > len(self.power):
            self.grow(max(n, 2 * len(self.power)))
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~self.sep[data]
        start = inside[1:] & ~inside[:-1]
        end = inside[:-1] & ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        both = cuts[inside[cuts] & inside[cuts + 1]]  # a word ends where the next text begins
        start[both] = True
        end[both] = True
        starts, ends = np.flatnonzero(start), np.flatnonzero(end)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:n], out=sums[1:])
        hashes = mix64((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64)) if len(starts) else np.zeros(0, np.uint64)
        return starts, ends, hashes, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, size: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hashes of ``size`` consecutive word hashes; entry i is for the window that starts at word i."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    b = np.uint64(base)
    for k in range(size):
        out *= b
        out += hashes[k : k + n]
    return mix64(out)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as rows (node, root), root being the smallest node reachable.

    Alternates large-star and small-star steps: each is a minimum per node with map-side combine and an equi-join, so a
    node of any degree is never gathered in one task. Rounds grow with the logarithm of the longest path. Each round is
    checkpointed. Nodes without edges, loops and rows with a null are left out.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = cut(pairs)
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", "m")).distinct()
        pairs = cut(small)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
