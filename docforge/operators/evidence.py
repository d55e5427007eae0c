"""Which texts hold which passages, white space and punctuation aside."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.functions.text import evidence_key, once
from docforge.session import ship

#: Characters of the passages of one automaton, and of those that the driver collects at once.
PART, GROUP = 1 << 20, 1 << 24


def compact(c: str) -> F.Column:
    return F.replace(evidence_key(F.col(c)), F.lit(" "), F.lit(""))


def holds(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id) of each text whose compact key holds the item's.

    Passages of any number are dealt into groups by a hash; the driver holds one at a time, an automaton a part of one.
    Each batch of texts is read once for a group. Items with an empty key are in no text; null texts hold nothing.
    """
    ship(docs.sparkSession)
    keyed = once(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")), key=compact("t")).where("key <> ''").select("doc_id", "key")
    goals = items.select(F.col(item_id).alias("item_id"), compact(item_text).alias("key")).where("key <> ''").distinct()
    total = goals.agg(F.sum(F.char_length("key"))).first()[0] or 0
    groups = max(1, -(-total // GROUP))
    out = None
    for g in range(groups):
        own = goals.where(F.pmod(F.xxhash64("key"), F.lit(groups)) == g) if groups > 1 else goals
        found = _pass(keyed, [(r.item_id, r.key) for r in own.collect()], goals.schema["item_id"].dataType.simpleString())
        out = found if out is None else out.unionByName(found)
    return out


def _pass(keyed: DataFrame, items: list[tuple], kind: str) -> DataFrame:
    parts: list[dict] = [{}]
    room = PART
    for name, key in items:
        if room < len(key) and parts[-1]:
            parts, room = [*parts, {}], PART
        room -= len(key)
        parts[-1].setdefault(key, []).append(name)
    shared = [keyed.sparkSession.sparkContext.broadcast(p) for p in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            texts, docs, names = batch.column(1).to_pylist(), [], []
            for part in shared:
                if kept is None or kept[0] is not part:
                    kept = (part, automaton(part.value))
                for i, t in enumerate(texts if len(kept[1]) else []):
                    found = {n for _, own in kept[1].iter(t) for n in own}
                    docs += [i] * len(found)
                    names += found
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs, pa.int64())), pa.array(names, pa.from_numpy_dtype("int64") if kind == "bigint" else pa.int32() if kind == "int" else pa.string())], names=["doc_id", "item_id"])

    return keyed.mapInArrow(run, f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, item_id {kind}")


def automaton(keys: dict[str, list]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for key, names in keys.items():
        out.add_word(key, names)
    out.make_automaton()
    return out
