"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of all items."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import map_arrow, widened, written

#: Bytes of item text that the driver collects and sends out at once; a larger set takes a pass for each further group.
MAX_ITEM_BYTES = 16 << 20
#: Windows in one automaton, some 100 MB; a larger group is several automata that GROUP_BYTES of text meet in turn.
MAX_WINDOWS = 100_000
#: Bytes of text that meet several automata in turn, each built once for them.
GROUP_BYTES = 64 << 20
#: a-z, 0-9 and all bytes of non-ASCII characters are kept, A-Z lower-cased, the rest separates words.
NORMAL = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SCHEMA = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:int,end:int>>>"
#: A word is three characters, each from a range of its own, so that matches begin at words and nodes have few branches.
BASE, UNKNOWN = 128, "\uffff" * 3
_matchers: dict = {}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Matcher:
    """One automaton over the windows of items: ``size`` consecutive words, or all of a shorter item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int) -> None:
        self.code: dict[bytes, str] = {}
        names: dict[str, set[str]] = {}
        for name, words in items:
            codes = [self.code.setdefault(w, self._coded(len(self.code))) for w in words]
            for i in range(max(1, len(codes) - size + 1) if codes else 0):
                names.setdefault("".join(codes[i : i + size]), set()).add(name)
        self.automaton = ahocorasick.Automaton()
        for window, of in names.items():
            self.automaton.add_word(window, (len(window) // 3, tuple(of)))
        self.automaton.make_automaton()

    @staticmethod
    def _coded(n: int) -> str:
        return chr(0xE000 + n // BASE**2) + chr(BASE + n // BASE % BASE) + chr(2 * BASE + n % BASE)

    def find(self, words: list[bytes], delta: np.ndarray, items: set[str]) -> None:
        """Add the items of the windows that occur, and the ends of the occurrences to ``delta``."""
        if not self.code or self.code.keys().isdisjoint(words):
            return
        get = self.code.get
        for end, (size, of) in self.automaton.iter("".join([get(w, UNKNOWN) for w in words])):
            last = (end + 1) // 3
            delta[last - size] += 1
            delta[last] -= 1
            items.update(of)


def matcher(key: str, items: list, size: int) -> Matcher:
    """One automaton per Python worker is kept."""
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(items, size)
    return _matchers[key]


def parts(items: list[tuple[str, bytes]], size: int) -> list[list[tuple[str, list[bytes]]]]:
    """Items in parts of at most MAX_WINDOWS windows; a longer item is in several, of which each has whole windows."""
    out: list[list] = [[]]
    room = MAX_WINDOWS
    for name, text in items:
        words, at = words_of(text), 0
        while words and (at == 0 or len(words) - at >= size):
            if not room:
                out, room = [*out, []], MAX_WINDOWS
            count = min(room, max(1, len(words) - size + 1 - at))
            out[-1].append((name, words[at : at + count + size - 1]))
            room, at = room - count, at + count
    return out


def grouped(batches: Iterator[pa.RecordBatch], at: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``most`` bytes of their column ``at``, or one that is larger."""
    held, size = [], 0
    for batch in batches:
        own = batch.column(at).nbytes
        if held and size + own > most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def spans_of(text: bytes, hit: np.ndarray) -> list[dict]:
    """Byte spans of the runs of hit words."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    inside = np.concatenate([[False], np.frombuffer(text.translate(NORMAL), np.uint8) != 32, [False]])
    starts, stops = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    return [{"start": int(starts[a]), "end": int(stops[b - 1])} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 13, out: str = "contamination") -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, items (sorted as strings) and byte spans of the hit words.

    Words are taken as in NORMAL. A window is ``size`` consecutive words of an item, or all words of a shorter one; a
    document word inside any occurrence is hit. Null and empty texts have no words; items without words or with a null
    id are left out; repeated items count once by id. Without items nothing is hit. A column of ``docs`` called ``out``
    is replaced. Repeated rows come out alike.

    The texts are read once, for a benchmark of up to MAX_ITEM_BYTES. A larger one is dealt into groups by a hash of the
    item's id and text; the driver holds one group at a time, and each takes a pass whose result is written.
    """
    named = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("string").alias("n"), F.col(item_text).cast("string").alias("t")).distinct()
    total = named.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    groups = max(1, -(-total // MAX_ITEM_BYTES))
    found = docs.drop(out)
    for g in range(groups):
        own = named.where(F.pmod(F.xxhash64("n", "t"), F.lit(groups)) == g) if groups > 1 else named
        rows = sorted((r.n, r.t.encode()) for r in own.collect())
        if g:
            found = _merge(_pass(found.withColumnRenamed(out, "_before"), rows, text, size, out), out, text)
        else:
            found = _pass(found, rows, text, size, out)
        if groups > 1:
            found = written(found)
    return found


def _pass(docs: DataFrame, items: list[tuple[str, bytes]], text: str, size: int, out: str) -> DataFrame:
    shared = [(uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(part)) for part in parts(items, size)]
    at = docs.columns.index(text)
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, at, GROUP_BYTES) if len(shared) > 1 else batches:
            column = batch.column(at).cast(pa.large_binary())
            raw = lambda i: column[i].as_buffer().to_pybytes() if column[i].is_valid else b""  # noqa: B023, E731
            many, hits, names = [0] * len(column), {}, {}
            for key, part in shared:
                own = matcher(key, part.value, size)
                for i in range(len(column)):
                    words, found = words_of(raw(i)), set()
                    many[i] = len(words)
                    delta = hits.get(i)
                    delta = np.zeros(len(words) + 1, np.int64) if delta is None else delta
                    own.find(words, delta, found)
                    if found:
                        hits[i], names[i] = delta, names.get(i, set()) | found
            covered = {i: np.cumsum(delta[:-1]) > 0 for i, delta in hits.items()}
            columns = [
                many, [int(covered[i].sum()) if i in covered else 0 for i in range(len(column))], [sorted(names.get(i, ())) for i in range(len(column))],
                [spans_of(raw(i), covered[i]) if i in covered else [] for i in range(len(column))],
            ]
            struct = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, out])

    return map_arrow(docs, run, widened(docs.schema, f"{out} {SCHEMA}"))


def _merge(df: DataFrame, out: str, text: str) -> DataFrame:
    """Union of the hits of two passes: spans that meet are merged and the words inside counted anew."""
    a, b = F.col("_before"), F.col(out)
    spans = F.array_sort(F.concat(a["spans"], b["spans"]))
    kind = "array<struct<start:int,end:int>>"

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when(F.size(acc) == 0, F.array(x)).when(x["start"] < last["end"], joined).otherwise(F.concat(acc, F.array(x)))

    merged = F.aggregate(spans, F.lit([]).cast(kind), add)
    raw = F.encode(F.col(text), "UTF-8")
    part = lambda s: F.decode(F.substring(raw, s["start"] + 1, s["end"] - s["start"]), "ISO-8859-1")
    words = F.aggregate(merged, F.lit(0).cast("long"), lambda n, s: n + F.size(F.regexp_extract_all(part(s), F.lit(r"[0-9A-Za-z\x80-\xff]+"), F.lit(0))))
    struct = F.struct(a["n_words"].alias("n_words"), words.alias("n_hit"), F.array_sort(F.array_union(a["items"], b["items"])).alias("items"), merged.alias("spans"))
    return df.withColumn(out, struct).drop("_before")
