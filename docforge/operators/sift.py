"""A bit map of keys that is broadcast before a join, so that rows without a partner are never shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the smallest and the largest map; a full one lets more rows on to the join, which is exact.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26
BITS_A_KEY = 16


def key_map(keys: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(words of the map, its bits) of hashed keys: 8 MB at most, whatever the number of keys."""
    wanted, bits = BITS_A_KEY * keys.count(), LEAST_BITS
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    bit = F.xxhash64(column).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftrightunsigned(bit, 6).alias("_slot"), bit.bitwiseAND(F.lit(63)).cast("int").alias("_bit"))
    return words.groupBy("_slot").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_word")), bits


def sifted(df: DataFrame, column: str, words: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the map, rows whose key surely isn't)."""
    bit = F.xxhash64(column).bitwiseAND(F.lit(bits - 1))
    held = df.withColumn("_slot", F.shiftrightunsigned(bit, 6)).withColumn("_bit", bit.bitwiseAND(F.lit(63)).cast("int"))
    held = held.join(F.broadcast(words), "_slot", "left")
    inside = F.coalesce(F.expr("getbit(_word, _bit) = 1"), F.lit(False))
    return held.where(inside).select(*df.columns), held.where(~inside).select(*df.columns)
