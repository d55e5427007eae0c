"""Toxicity by a support vector machine on a gap-weighted subsequence kernel of sentences with Nyström landmarks."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import WordHasher, map_arrow, widened
from docforge.llm.langid import learnable

#: Bounds of the training sample: documents of each label (at most) and bytes of a document.
SAMPLE_DOCS, SAMPLE_BYTES = 3072, 1 << 16
#: Landmarks, their symbols, rounds of choosing landmarks and fitting anew.
LANDMARKS, LANDMARK, ROUNDS = 384, 12, 3
#: Subsequences of three symbols that span at most SPAN; each symbol that one spans beyond three weighs it by DECAY.
SPAN, DECAY = 6, 0.5
#: Weight of the squared norm of f beside the losses.
RIDGE = 0.3
#: Symbols of a sentence from which on it is cut at the next space; characters of a text worked on at once.
LONGEST, STEP = 128, 1 << 19
#: Symbols: letters and digits from 1 on (others than a-z and 0-9 share the numbers from OTHER on), SPACE. 0 is left out.
OTHER, SPACE = 37, 127


#: Where a long text may be cut: a sentence ends, and no single letter stands beside, to which others could be joined.
SENTENCE = re.compile(r"(?<=[^\W_]{2}[.!?])\s(?=[^\W_]{2})|(?<=[^\W_]{2})\n(?=[^\W_]{2})")


def _symbols() -> np.ndarray:
    out = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c.isspace():
            out[code] = SPACE
        elif c.isalnum():
            base = unicodedata.normalize("NFD", c)[0]
            plain = base if base.isascii() else c
            out[code] = ord(plain) - 96 if "a" <= plain <= "z" else ord(plain) - 21 if "0" <= plain <= "9" else OTHER + code % (SPACE - OTHER)
    return out


SYMBOLS = _symbols()


class Units:
    """Sentences of a list of lower-case texts as one array of symbols: ``start`` of each, the ``text`` it is of.

    A sentence begins at a line feed, and at white space after ``.``, ``!`` or ``?``; one of over LONGEST symbols is cut at
    spaces. Letters without accents; punctuation is left out, so are spaces between single letters, repeated spaces and
    a word that repeats the one before it.
    """

    hasher = WordHasher(np.arange(256) == SPACE)

    def __init__(self, texts: list[str]) -> None:
        sizes = np.array([len(t) + 2 for t in texts], np.int64)
        code = np.frombuffer("".join(f" {t}\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = SYMBOLS[np.minimum(code, 0xFFFF)]
        high = np.flatnonzero(code > 0xFFFF)
        sym[high] = OTHER + code[high] % (SPACE - OTHER)
        text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        first = (code == 10) | np.concatenate([[True], (sym[1:] == SPACE) & np.isin(code[:-1], (33, 46, 63))])[: len(code)]
        first[np.cumsum(sizes) - sizes] = True
        sentence = np.cumsum(first, dtype=np.int32)
        keep = sym > 0
        sym, text, sentence = sym[keep], text[keep], sentence[keep]
        gap = np.concatenate([[True] * 2, sym == SPACE, [True] * 2])
        lone = gap[2:-2] & gap[:-4] & gap[4:] & ~gap[1:-3] & ~gap[3:-1]
        keep = ~(lone | (gap[2:-2] & gap[1:-3] & np.concatenate([[False], sentence[1:] == sentence[:-1]])[: len(sym)]))
        sym, text, sentence = sym[keep], text[keep], sentence[keep]
        begin, end, word, _ = self.hasher.words(sym, np.array([0, len(sym)]))
        again = np.flatnonzero((word[1:] == word[:-1]) & (sentence[begin[1:]] == sentence[begin[:-1]])) + 1 if len(word) else np.zeros(0, int)
        gone = np.zeros(len(sym) + 1, np.int32)
        gone[begin[again] - 1] += 1
        gone[end[again]] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        self.sym, text, sentence = sym[keep], text[keep], sentence[keep]
        n = len(self.sym)
        new = np.concatenate([[True], sentence[1:] != sentence[:-1]])[:n]
        begin = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, np.int64)
        word = np.maximum.accumulate(np.where((self.sym == SPACE) | new, np.arange(n), 0)) if n else begin
        part = (word - begin) // LONGEST
        self.start = np.flatnonzero(new | np.concatenate([[True], part[1:] != part[:-1]])[:n])
        self.text = text[self.start]
        self.size = np.diff(np.append(self.start, n))

    def take(self, chosen: np.ndarray) -> Units:
        """The chosen sentences, in that order."""
        out = Units([])
        at = np.repeat(self.start[chosen] - np.concatenate([[0], np.cumsum(self.size[chosen])[:-1]]), self.size[chosen]) + np.arange(self.size[chosen].sum())
        out.sym, out.size, out.text = self.sym[at], self.size[chosen], self.text[chosen]
        out.start = np.cumsum(out.size) - out.size
        return out

    @staticmethod
    def of(strings: list[np.ndarray]) -> Units:
        out = Units([])
        out.sym, out.size, out.text = np.concatenate([*strings, np.zeros(0, np.uint8)]), np.array([len(s) for s in strings], np.int64), np.arange(len(strings))
        out.start = np.cumsum(out.size) - out.size
        return out

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(first symbols, numbers of the subsequences, weight) for each pair of distances to the second and third."""
        s = self.sym.astype(np.int32)
        left = np.repeat(self.start + self.size, self.size) - np.arange(len(s))  # symbols up to the sentence's end
        for span in range(3, SPAN + 1):
            at = np.flatnonzero(left >= span)
            outer = s[at] << 14 | s[at + span - 1]
            for middle in range(1, span - 1):
                yield at, outer | s[at + middle] << 7, DECAY ** (span - 3)

    def norms(self) -> np.ndarray:
        """The root of the summed squares of the weights: scales sentences to one length, as of distinct subsequences."""
        total = np.zeros(len(self.start))
        for span in range(3, SPAN + 1):
            total += np.maximum(self.size - span + 1, 0) * (span - 2) * DECAY ** (2 * (span - 3))
        return np.sqrt(np.maximum(total, 1e-12))

    def places(self, table: np.ndarray) -> np.ndarray:
        """At each symbol, the weighted sum of ``table`` over the subsequences that begin there."""
        out = np.zeros(len(self.sym), np.float32)
        for at, number, weight in self.features():
            out[at] += np.float32(weight) * table[number]
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float64), self.start) if len(self.start) else np.zeros(0)

    def __len__(self) -> int:
        return len(self.start)


def gram(a: Units, b: Units) -> np.ndarray:
    """The normalised kernel of the sentences of ``a`` with those of ``b``: the sum over common subsequences of the
    products of their weights, over both norms."""
    rows = [(np.repeat(np.arange(len(b)), b.size)[at], number, weight) for at, number, weight in b.features()]
    columns = np.unique(np.concatenate([number for _, number, _ in rows]))
    place = np.full(1 << 21, -1, np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    dense = np.zeros((len(columns), len(b)), np.float32)
    for row, number, weight in rows:
        np.add.at(dense, (place[number], row), np.float32(weight))
    out, owner = np.zeros((len(a), len(b)), np.float32), np.repeat(np.arange(len(a)), a.size)
    for at, number, weight in a.features():
        column = place[number]
        known = column >= 0
        column, row = column[known], owner[at[known]]
        for i in range(0, len(row), 1 << 14):
            part = row[i : i + (1 << 14)]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            out[part[first]] += np.float32(weight) * np.add.reduceat(dense[column[i : i + (1 << 14)]], first, axis=0)
    return out / (a.norms()[:, None] * b.norms())


class Classifier:
    """f(s) = sum of alpha_j K(s, landmark_j) + bias over sentences s; a text is as toxic as its worst sentence.

    K has an explicit feature space, the subsequences, so the sum over landmarks is one table of weights by subsequence,
    and a sentence costs the same for any number of landmarks. The first f weighs subsequences by how much more often
    they stand in label 1. Then, ROUNDS times, each text gives the sentence that f finds worst (label 0 also those of the
    rounds before); landmarks are drawn at random among the worst stretches of these sentences, three quarters of them
    of label 1, and a support vector machine with squared hinge loss is fitted to the Nyström features of the sentences.
    At last margins are calibrated.
    """

    def __init__(self, rows: list[tuple[str, int]], seed: int = 5) -> None:
        rows = sorted(set(rows))
        labels = np.array([label for _, label in rows], int)
        self.table, self.bias, self.slope, self.shift = np.zeros(1 << 21, np.float32), 0.0, 0.0, 0.0
        self.landmarks, self.alpha = Units([]), np.zeros(0)
        if not 0 < labels.sum() < len(labels):
            rate = float(labels.mean()) if len(labels) else 0.0
            self.shift = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
            return
        parts = [self._part(rows[i : i + 1024], i) for i in range(0, len(rows), 1024)]
        self._contrast(parts, labels)
        rng = np.random.default_rng(seed)
        hard: dict[int, np.ndarray] = {}
        for _ in range(ROUNDS):
            self._fit(parts, labels, rng, hard)
        self._calibrate(np.concatenate([self._margins(units, n) for units, n, _ in parts]), labels)

    @staticmethod
    def _part(rows: list[tuple[str, int]], first: int) -> tuple[Units, int, int]:
        return Units([t.lower() for t, _ in rows]), len(rows), first

    def _contrast(self, parts: list, labels: np.ndarray) -> None:
        sums = np.zeros((2, 1 << 21))
        for units, _, first in parts:
            toxic = np.repeat(labels[first + units.text], units.size) == 1
            for at, number, weight in units.features():
                for label in (0, 1):
                    sums[label] += weight * np.bincount(number[toxic[at] == label], minlength=1 << 21)
        total = np.maximum(sums.sum(axis=1), 1)
        rate = sums / total[:, None]
        self.table = ((rate[1] - rate[0]) / np.sqrt((rate / total[:, None]).sum(axis=0) + 1 / total.min() ** 2)).astype(np.float32)

    def values(self, units: Units) -> np.ndarray:
        """f of each sentence, without the bias."""
        return units.sums(units.places(self.table)) / units.norms()

    def _margins(self, units: Units, texts: int) -> np.ndarray:
        worst = np.full(texts, -np.inf)
        np.maximum.at(worst, units.text, self.values(units))
        return np.where(np.isinf(worst), 0.0, worst) + self.bias

    def _fit(self, parts: list, labels: np.ndarray, rng: np.random.Generator, hard: dict) -> None:
        chosen, stretches = [], ([], [])
        for units, _, first in parts:
            places = units.places(self.table)
            values = units.sums(places) / units.norms() + self.bias
            order = np.lexsort((values, units.text))
            worst = order[np.flatnonzero(np.concatenate([units.text[order][1:] != units.text[order][:-1], [True]]))]
            toxic = labels[first + units.text[worst]] == 1
            hard[first] = np.union1d(hard.get(first, worst[:0]), worst[~toxic])
            own = units.take(np.concatenate([worst[toxic], hard[first]]))
            own.text = own.text + first
            chosen.append(own)
            sums = np.concatenate([[0.0], np.cumsum(places, dtype=np.float64)])
            for u in worst[np.where(toxic, values[worst] > 0, True)].tolist():
                a, size = int(units.start[u]), int(units.size[u])
                width = min(LANDMARK, size)
                if size >= 3:
                    begin = a + int(np.argmax(sums[a + width : a + size + 1] - sums[a : a + size + 1 - width]))
                    stretches[labels[first + units.text[u]]].append((float(values[u]), units.sym[begin : begin + width].tobytes()))
        drawn = []
        for label, most in ((1, LANDMARKS * 3 // 4), (0, LANDMARKS // 4)):
            unique = sorted({w: v for v, w in stretches[label]}.items())
            drawn += [unique[i][0] for i in sorted(rng.permutation(len(unique))[:most].tolist())]
        if not drawn:
            return
        self.landmarks = Units.of([np.frombuffer(d, np.uint8) for d in drawn])
        value, vector = np.linalg.eigh(gram(self.landmarks, self.landmarks).astype(np.float64))
        root = (vector / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
        x = np.concatenate([gram(units, self.landmarks) for units in chosen]) @ root
        x = np.column_stack([x, np.ones(len(x))])
        y = labels[np.concatenate([units.text for units in chosen])]
        sign, cost = np.where(y == 1, 1.0, -1.0), np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        w, ridge = np.zeros(x.shape[1]), np.diag([RIDGE] * (x.shape[1] - 1) + [1e-6])
        for _ in range(15):  # Newton steps of the squared hinge loss
            active = sign * (x @ w) < 1
            own = x[active] * cost[active, None]
            w = np.linalg.solve(ridge + own.T @ x[active], own.T @ sign[active])
        self.alpha, self.bias = root @ w[:-1], float(w[-1])
        self.table = np.zeros(1 << 21, np.float32)
        scaled = (self.alpha / self.landmarks.norms()).astype(np.float32)
        owner = np.repeat(np.arange(len(self.landmarks)), self.landmarks.size)
        for at, number, weight in self.landmarks.features():
            np.add.at(self.table, number, np.float32(weight) * scaled[owner[at]])

    def _calibrate(self, margins: np.ndarray, labels: np.ndarray) -> None:
        """Logistic regression on the margins, with a weak prior that keeps separable ones finite."""
        scale = max(float(margins.std()), 1e-9)
        x, w = np.column_stack([margins / scale, np.ones(len(margins))]), np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + 0.1 * np.eye(2), x.T @ (p - labels) + 0.1 * w)
            w -= step
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.shift = float(w[0]) / scale, float(w[1])

    def scores(self, texts: list[str]) -> list[float]:
        """Probability of label 1 by the worst sentence of each text."""
        out, i = [], 0
        while i < len(texts):
            j, size = i + 1, len(texts[i])
            while j < len(texts) and size + len(texts[j]) <= STEP:
                size, j = size + len(texts[j]), j + 1
            if size <= 2 * STEP:
                margins = self._margins(Units([t.lower() for t in texts[i:j]]), j - i)
            else:  # one long text, in pieces of whole sentences
                margins = np.array([max(float(self._margins(Units([piece.lower()]), 1)[0]) for piece in self._pieces(texts[i]))])
            out += (1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))).tolist()
            i = j
        return out

    @staticmethod
    def _pieces(text: str) -> Iterator[str]:
        """Whole sentences of STEP characters or more: a piece ends where a sentence does."""
        begin = 0
        while begin < len(text):
            end = SENTENCE.search(text, begin + STEP) if len(text) - begin > 2 * STEP else None
            yield text[begin : end.start() if end else len(text)]
            begin = end.start() if end else len(text)


def sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str) -> list[tuple[str, int]]:
    """(text, label): at most SAMPLE_DOCS learnable documents of each label, one for each of as many hash buckets.

    One row for each id, whose first text in order is learnt; an id with both labels counts as label 1.
    """
    marks = labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & learnable(F.col("i")))
    h = F.xxhash64(F.col("i").cast("string"))
    marks = marks.groupBy("y", F.pmod(F.xxhash64(h), F.lit(SAMPLE_DOCS)).alias("b")).agg(F.min(F.struct(h.alias("h"), "i")).alias("m")).select("m.i", "y")
    own = docs.select(F.col(doc_id).alias("i"), F.col(text).cast("string").alias("t")).where(F.octet_length("t").between(1, SAMPLE_BYTES))
    rows = own.join(F.broadcast(marks), "i").groupBy("i").agg(F.min("t").alias("t"), F.max("y").alias("y"))  # at most 2 * SAMPLE_DOCS ids
    return sorted((r.t, r.y) for r in rows.collect())


def classify(docs: DataFrame, model: Classifier, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``out``, of whole texts; null and empty texts are scored too, alike."""
    docs = docs.drop(out)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = own.scores([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, out])

    return map_arrow(docs, run, widened(docs.schema, f"{out} double"))


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", out: str = "score") -> DataFrame:
    """Learn from a bounded sample of the labelled documents that are not held out, then score all of ``docs``.

    Without rows of both labels every document gets the rate of label 1. Labels that are null or neither 0 nor 1, and
    labels of ids that no document has, are left out; columns of ``docs`` called ``out`` are replaced. Repeated rows come
    out alike; an empty table stays empty. A long text is scored in pieces of whole sentences, some STEP characters each, or one
    sentence if that is longer, with the score of the whole.
    """
    return classify(docs, Classifier(sample(docs, labels, text, doc_id, label)), text, out)
