"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import cut, map_arrow, text_chunks, widened

#: Bounds of the training sample: documents of a language, documents in all (but one for each language), bytes of a document.
SAMPLE_DOCS, SAMPLE_ALL, SAMPLE_BYTES = 256, 1 << 14, 1 << 16
#: Bytes of context, languages that share a table, bytes of text that are scored at once.
ORDER, GROUP, STEP = 3, 8, 1 << 18
#: Letters keep their byte with A-Z lower-cased; every other ASCII byte is a space.
FOLD = np.array([b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


def learnable(doc_id: Column) -> Column:
    """True where crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, text: str, lang: str, doc_id: str) -> list[tuple[str, str]]:
    """(language, text): of each language at most SAMPLE_DOCS learnable documents, fewer if there are so many languages
    that all of them would be over SAMPLE_ALL; one for each of as many hash buckets.

    The document of a bucket is the one with the smallest hash, of at most SAMPLE_BYTES where there is one (else its first
    SAMPLE_BYTES characters are learnt), so the choice is by a minimum with map-side combine. One row for each id.
    """
    own = docs.select(F.col(doc_id).alias("i"), F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t")).where(
        F.col("l").isNotNull() & F.col("t").isNotNull() & learnable(F.col("i")) & (F.octet_length("t") > 0)
    )
    many = own.select("l").distinct().count()
    each = max(1, min(SAMPLE_DOCS, SAMPLE_ALL // max(1, many)))
    h = F.xxhash64(F.col("i").cast("string"))
    order = F.struct((F.octet_length("t") > SAMPLE_BYTES).alias("long"), h.alias("h"), "i")
    picked = own.groupBy("l", F.pmod(F.xxhash64(h), F.lit(each)).alias("b")).agg(F.min(order).alias("m")).select("l", "m.i")
    wanted = F.broadcast(cut(picked))  # at most SAMPLE_ALL rows, or one for each language
    rows = own.join(wanted, ["l", "i"]).groupBy("l", "i").agg(F.min(F.substring("t", 1, SAMPLE_BYTES)).alias("t"))
    return sorted((r.l, r.t) for r in rows.collect())


class Places:
    """Where 32-bit keys stand in a sorted array: one probe of a hash table, a binary search for the few it has lost."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.shift = np.uint32(32 - max(8, int(8 * len(keys)).bit_length()) if len(keys) < 1 << 26 else 2)
        self.slots = np.full(1 << (32 - int(self.shift)), -1, np.int32)
        slot = self._slot(keys)
        self.slots[slot] = np.arange(len(keys), dtype=np.int32)
        self.lost = np.flatnonzero(self.slots[slot] != np.arange(len(keys))).astype(np.int32)
        self.lost_keys = keys[self.lost]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(2654435761)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self.slots[self._slot(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        out = at.copy()
        out[wrong] = -1
        if len(self.lost):
            wrong = wrong[at[wrong] >= 0]
            place = np.searchsorted(self.lost_keys, keys[wrong]).clip(max=len(self.lost) - 1)
            good = self.lost_keys[place] == keys[wrong]
            out[wrong[good]] = self.lost[place[good]]
        return out


class Tree:
    """Context trees of a few languages, order by order: code lengths of the symbols seen after a context, and escapes.

    Method C: a context with n symbols of d kinds gives a symbol seen c times c/(n+d) and the escape d/(n+d); an escape
    goes on with the next shorter context, at last with all 256 bytes alike. A context that a language never saw is
    passed over without cost. A row stands for a context and symbol that one of the languages saw and has the whole
    length under each language, exact for the frozen counts; what none of them saw is added up from escapes.
    """

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> None:
        many = len(grams)
        self.seen, self.bits, self.contexts, self.escapes = [], [], [], []
        for order in range(ORDER + 1):
            mask = np.uint32(2 ** (8 * (order + 1)) - 1)
            own = []
            for keys, counts in grams:
                short, at = np.unique(keys & mask, return_inverse=True)
                own.append((short, np.bincount(at, counts, minlength=len(short))))
            seen = np.unique(np.concatenate([k for k, _ in own]))
            context = np.unique(seen >> np.uint32(8)) if order else np.zeros(1, np.uint32)
            lower = self.bits[-1][self.seen[-1].find(seen & (mask >> np.uint32(8)))] if order else np.full((len(seen), many), 8.0, np.float32)
            bits, escapes = np.zeros((len(seen), many), np.float32), np.zeros((len(context), many), np.float32)
            of = np.searchsorted(context, seen >> np.uint32(8)) if order else np.zeros(len(seen), int)
            for k, (keys, counts) in enumerate(own):
                at = np.searchsorted(context, keys >> np.uint32(8)) if order else np.zeros(len(keys), int)
                n, d = np.bincount(at, counts, minlength=len(context)), np.bincount(at, minlength=len(context))
                with np.errstate(divide="ignore", invalid="ignore"):
                    escapes[:, k] = np.where(n > 0, -np.log2(d / (n + d)), 0)
                bits[:, k] = escapes[of, k] + lower[:, k]
                bits[np.searchsorted(seen, keys), k] = -np.log2(counts / (n + d)[at])
            self.seen.append(Places(seen))
            self.bits.append(bits)
            self.contexts.append(Places(context))
            self.escapes.append(escapes)

    def lengths(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each key after the other three, under each language."""
        out = np.zeros((len(keys), self.bits[0].shape[1]), np.float32)
        left = np.arange(len(keys))
        for order in range(ORDER, -1, -1):
            own = keys if order == ORDER else keys[left] & np.uint32(2 ** (8 * (order + 1)) - 1)
            at = self.seen[order].find(own)
            hit = at >= 0
            out[left[hit]] += self.bits[order][at[hit]]
            left, own = left[~hit], own[~hit]
            if not len(left):
                return out
            context = self.contexts[order].find(own >> np.uint32(8)) if order else np.zeros(len(own), np.int32)
            known = context >= 0
            out[left[known]] += self.escapes[order][context[known]]
        out[left] += 8
        return out


class Model:
    """Order-3 context trees of every language, GROUP languages to a Tree, so that memory follows the contexts seen."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.languages = sorted({r[0] for r in rows})
        grams: dict[str, list] = {name: [] for name in self.languages}
        for name, text in rows:
            data = FOLD[np.frombuffer(text.encode(), np.uint8)]
            grams[name].append(np.unique(self._keys(data, np.array([0, len(data)]), 0, len(data)), return_counts=True))
        counted = []
        for name in self.languages:
            keys, at = np.unique(np.concatenate([k for k, _ in grams[name]]), return_inverse=True)
            counted.append((keys, np.bincount(at, np.concatenate([c for _, c in grams[name]]))))
        self.trees = [Tree(counted[i : i + GROUP]) for i in range(0, len(counted), GROUP)]

    @staticmethod
    def _keys(folded: np.ndarray, offsets: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Each byte from ``start`` to ``stop`` with the three before it in its text; a text begins after spaces."""
        out = np.zeros(stop - start, np.uint32)
        first = offsets[:-1][(offsets[:-1] < stop) & (offsets[1:] > start)]
        for back in range(ORDER, -1, -1):
            own = folded[max(0, start - back) : max(0, stop - back)]
            own = np.concatenate([np.full(stop - start - len(own), 32, np.uint8), own]).astype(np.uint32)
            for k in range(back):
                at = first + k - start
                own[at[(at >= 0) & (at < len(own))]] = 32
            out = (out << np.uint32(8)) | own
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language; memory is bounded however long a text is."""
        folded, total = FOLD[data], np.zeros((len(offsets) - 1, len(self.languages)))
        for start in range(0, len(data), STEP):
            stop = min(len(data), start + STEP)
            keys = self._keys(folded, offsets, start, stop)
            edge = offsets.clip(start, stop) - start
            for k, tree in enumerate(self.trees):
                bits = tree.lengths(keys)
                sums = np.zeros((len(bits) + 1, bits.shape[1]))
                np.cumsum(bits, axis=0, dtype=np.float64, out=sums[1:])
                total[:, k * GROUP : k * GROUP + bits.shape[1]] += sums[edge[1:]] - sums[edge[:-1]]
        return total


def posterior(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the shortest code, its share when all languages are as likely beforehand)."""
    best = bits.argmin(axis=1)
    with np.errstate(under="ignore"):
        share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
    return best, share


def has_letter(raw: bytes) -> bool:
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    return any(c.isalpha() for i in range(0, len(raw), 4096) for c in decoder.decode(raw[i : i + 4096]))


def predict(docs: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score", bits_out: str = "bits_per_byte") -> DataFrame:
    """``docs`` with the predicted language, its posterior share and the bits a byte of its code.

    A null or empty text, one without a letter, or a model without languages gives ``und`` and score 0. Ties go to the
    language that sorts first. Columns of ``docs`` with the names of the new ones are replaced. Texts of any length are
    scored whole, in steps of STEP bytes. Repeated rows come out alike; an empty table stays empty.
    """
    docs = docs.drop(lang_out, score_out, bits_out)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            names, scores, rates = [], [], []
            for i, data, offsets in text_chunks(batch.column(at), STEP):
                size = np.diff(offsets)
                many = len(size)
                if own.languages:
                    bits = own.code_lengths(data, offsets)
                    best, share = posterior(bits)
                    rate = bits.min(axis=1) / np.maximum(size, 1)
                else:
                    best, share, rate = np.zeros(many, int), np.zeros(many), np.zeros(many)
                raw = data.tobytes()
                for k in range(many):
                    known = bool(own.languages) and has_letter(raw[offsets[k] : offsets[k + 1]])
                    names.append(own.languages[best[k]] if known else "und")
                    scores.append(float(share[k]) if known else 0.0)
                    rates.append(float(rate[k]) if known else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names), pa.array(scores), pa.array(rates)], names=[*batch.schema.names, lang_out, score_out, bits_out])

    return map_arrow(docs, run, widened(docs.schema, f"{lang_out} string, {score_out} double, {bits_out} double"))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **names: str) -> DataFrame:
    """Learn from a bounded sample of the labelled documents, then predict for all."""
    return predict(docs, Model(sample(docs, text, lang, doc_id)), text, **names)
