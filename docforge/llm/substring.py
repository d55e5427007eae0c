"""Removal of passages that repeat across documents: winnowed anchors as seeds, extended to maximal repeats."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import SPACE, WordHasher, map_arrow, parted, sketch, text_chunks, windows, written

#: Words of an anchor. A window of n words is seeded by the smallest hash of its n - ANCHOR + 1 anchors.
ANCHOR = 4
#: Bits of the maps that say which anchors recur. A fuller map passes more rows on to the exact steps; results don't change.
MAP_BITS = 1 << 27
#: Bytes of text worked on at once. A longer text is taken in pieces that overlap by a window less one word.
STEP = 1 << 20
SECOND_BASE = 0xA24BAED4963EE407


class Windows:
    """The windows of a chunk of texts: the designated anchor of each, and runs of windows with one anchor."""

    def __init__(self, hasher: WordHasher, data: np.ndarray, offsets: np.ndarray, size: int) -> None:
        self.size, self.hasher = size, hasher
        _, _, self.hashes, first = hasher.words(data, offsets)
        n = len(self.hashes)
        own = np.repeat(np.arange(len(first) - 1), np.diff(first))  # text of each word
        self.at = np.arange(max(0, n - size + 1))
        if len(self.at):
            self.at = self.at[own[: n - size + 1] == own[size - 1 :]]
        self.text = own[self.at] if len(self.at) else np.zeros(0, int)
        self.place = self.at - first[self.text]
        low, width = windows(self.hashes, min(ANCHOR, size)), size - min(ANCHOR, size) + 1
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            low = np.minimum(low[:-step], low[step:])
            reach += step
        self.anchor = low[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def runs(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (as indexes of windows) of the runs of chosen windows with one text and anchor."""
        i = np.flatnonzero(chosen)
        if not len(i):
            return i, i
        new = np.concatenate([[True], (np.diff(i) > 1) | (self.anchor[i[1:]] != self.anchor[i[:-1]]) | (self.text[i[1:]] != self.text[i[:-1]])])
        begin = np.flatnonzero(new)
        return i[begin], i[np.concatenate([begin[1:], [len(i)]]) - 1]

    def spans(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of all words from the start of window ``first`` to the end of window ``last``."""
        n = len(self.hashes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * self.hasher.power[:n], out=sums[1:])
        start, stop = self.at[first], self.at[last] + self.size
        return (sums[stop] - sums[start]) * self.hasher.inverse[start] + (stop - start).astype(np.uint64)


def _pieces(data: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words before, bytes) of pieces of a long text such that each window of ``size`` words is in just one piece.

    A piece that would hold fewer words than a window, but some, is made longer, so that the next one begins later.
    """
    begin, before = 0, 0
    while True:
        end, starts = begin, np.zeros(0, np.int64)
        while True:
            old, end = end, min(len(data), end + STEP)
            while end < len(data) and not SPACE[data[end]]:
                end += 1
            inside = np.concatenate([[False], ~SPACE[data[old:end]]])  # ``old`` is the text's start, a word's or a space
            starts = np.concatenate([starts, np.flatnonzero(inside[1:] & ~inside[:-1]) + (old - begin)])
            if end == len(data) or not len(starts) or len(starts) >= size:
                break
        yield before, data[begin:end]
        if end == len(data):
            return
        kept = min(size - 1, len(starts))
        before += len(starts) - kept
        begin = end if not kept else begin + int(starts[-kept])


def _each(df: DataFrame, size: int, schema: str, emit: Callable[[Windows, np.ndarray], tuple | None]) -> DataFrame:
    """Rows that ``emit`` makes of each chunk's windows: arrays, of which the first has indexes into the windows."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACE)
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in text_chunks(batch.column(1), STEP):
                whole = [(0, data, offsets)]
                if len(data) > 2 * STEP:  # then it is one text
                    whole = ((before, piece, np.array([0, len(piece)])) for before, piece in _pieces(data, size))
                prints = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                for before, part, bounds in whole:
                    w = Windows(hasher, part, bounds, size)
                    if not len(w.at) or (made := emit(w, w.place + before)) is None or not len(made[0]):
                        continue
                    at = made[0]
                    doc = ids.take(pa.array(w.text[at] + row))
                    print_of = pa.array(np.array(prints, np.int64)[w.text[at]])
                    known, rest = {"doc_id": doc, "print": print_of}, iter(made[1:])
                    arrays = [known[n] if n in known else pa.array(next(rest)) for n in names]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_arrow(df.where("doc_id is not null"), run, schema)


def recurring(anchors: DataFrame, column: str = "a") -> np.ndarray:
    """A map of MAP_BITS bits with two bits set for each anchor; its size doesn't depend on the input."""
    bits = F.explode(F.array(*(F.shiftrightunsigned(column, s).bitwiseAND(F.lit(MAP_BITS - 1)) for s in (0, 32)))).alias("bit")
    slots = anchors.select(bits).groupBy(F.shiftrightunsigned("bit", 6).cast("int").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).toArrow()
    words = np.zeros(MAP_BITS // 64, np.uint64)
    words[slots["slot"].to_numpy()] = slots["word"].to_numpy().view(np.uint64)
    return words


def in_map(words: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    found = np.ones(len(anchors), bool)
    for s in (0, 32):
        bit = (anchors >> np.uint64(s)) & np.uint64(MAP_BITS - 1)
        found &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return found


def repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 13) -> DataFrame:
    """Rows (doc_id, print, place, many): windows that start at ``place`` and the ``many`` - 1 words after it, each of
    which also starts in a document with a smaller doc_id. ``print`` is the CRC-32 of the text.

    1. Seeds: every window designates its smallest anchor, so equal windows designate equal anchors. Anchors that two
       documents share are marked in a map of fixed size.
    2. Extension: windows in a row with one marked anchor are one run, which takes in all words that they cover. Where
       all runs of an anchor are the same words, the run repeats as a whole in every document but the first.
    3. Where an anchor has different runs, as at the ends of a repeat or at an edit, its single windows are compared by
       two 64-bit hashes, so that repeats end at the exact word. A further map holds what recurs among them.
    Each comparison is a minimum with map-side combine and an equi-join with one row for each key; no pairs of documents
    are made.
    """
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sc = df.sparkSession.sparkContext

    def seeds(w: Windows, _: np.ndarray) -> tuple:
        first, _last = w.runs(np.ones(len(w.at), bool))
        return first, w.anchor[first].view(np.int64)

    anchors = _each(source, size, "doc_id long, a long", seeds)
    shared = anchors.groupBy("a").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    marked = sc.broadcast(recurring(shared))

    def extended(w: Windows, place: np.ndarray) -> tuple:
        first, last = w.runs(in_map(marked.value, w.anchor))
        return first, w.anchor[first].view(np.int64), w.spans(first, last).view(np.int64), place[first].astype(np.int32), (last - first + 1).astype(np.int32)

    runs = written(_each(source, size, "doc_id long, print long, a long, s long, place int, many int", extended))
    by_anchor = written(runs.groupBy("a").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("s").alias("s0"), F.max("s").alias("s1")).where("low < high"))
    alike = by_anchor.where("s0 = s1").select("a", "low")
    whole = runs.join(alike, "a").where("doc_id > low").select("doc_id", "print", "place", "many")
    unlike = sc.broadcast(recurring(by_anchor.where("s0 <> s1")))

    def singles(chosen: Broadcast, single: Broadcast | None) -> Callable[[Windows, np.ndarray], tuple]:
        def emit(w: Windows, place: np.ndarray) -> tuple:
            at = np.flatnonzero(in_map(chosen.value, w.anchor))
            first = windows(w.hashes, size)[w.at[at]]
            if single is not None:
                good = in_map(single.value, first)
                at, first = at[good], first[good]
            return at, first.view(np.int64), windows(w.hashes, size, SECOND_BASE)[w.at[at]].view(np.int64), place[at].astype(np.int32)

        return emit

    schema = "doc_id long, print long, w1 long, w2 long, place int"
    earliest = _each(source, size, schema, singles(unlike, None)).groupBy("w1", "w2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    earliest = written(earliest.where("low < high").select("w1", "w2", "low"))
    again = _each(source, size, schema, singles(unlike, sc.broadcast(recurring(earliest, "w1"))))
    return whole.unionByName(again.join(earliest, ["w1", "w2"]).where("doc_id > low").select("doc_id", "print", "place", F.lit(1).alias("many")))


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 13) -> DataFrame:
    """Rows (doc_id, kept, n_words, n_removed), one for each input row.

    Words are runs of bytes other than space and 09-0D. A word goes if a window of ``size`` words that covers it also
    starts in a document with a smaller doc_id; windows are judged on the input. ``kept`` joins the words that stay by
    one space. Null and empty texts have no words. Rows with a null doc_id are kept whole and are no earlier document;
    rows that repeat a doc_id don't count against each other. Extra columns are ignored.
    """
    found = repeats(df, text, doc_id, size).groupBy("doc_id", "print").agg(F.collect_list(F.struct("place", "many")).alias("found"))
    found = written(found.withColumn("key", F.xxhash64("doc_id", "print")))
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    source = source.withColumn("print", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).withColumn("key", F.xxhash64("doc_id", "print"))
    some, rest = parted(source, "key", *sketch(found, "key"))
    joined = some.join(found.hint("shuffle_hash"), ["key", "doc_id", "print"], "left").select("doc_id", "text", F.col("found.place").alias("place"), F.col("found.many").alias("many"))
    none = F.lit(None).cast("array<int>")
    joined = joined.unionByName(rest.select("doc_id", "text", none.alias("place"), none.alias("many")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, removed = [], [], []
            for value, place, many in zip(batch.column(1).cast(pa.large_binary()), batch.column(2), batch.column(3), strict=True):
                words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                gone = 0
                if place.is_valid and words:
                    start, length = place.values.to_numpy(), many.values.to_numpy()
                    delta = np.zeros(len(words) + 1, np.int64)
                    np.add.at(delta, start, 1)
                    np.add.at(delta, start + length + size - 1, -1)
                    stay = np.cumsum(delta[:-1]) == 0
                    gone = len(words) - int(stay.sum())
                    counts.append(len(words))
                    words = [words[k] for k in np.flatnonzero(stay)]
                else:
                    counts.append(len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
                removed.append(gone)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=["doc_id", "kept", "n_words", "n_removed"])

    return map_arrow(joined, run, "doc_id long, kept string, n_words long, n_removed long")
