"""run() of the pipeline against plain Python, stage by stage, on a small table with every kind of trouble."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docforge.llm import langid, mixing
from tests.llm.test_operators import LOWER, find, jaccard, one_edit, slow_bits, tokens

pipeline = pytest.importorskip("corpus_pipeline")
KINDS = {"aa": "the of and ing tion er house green".split(), "bb": "der und ich ein sch ung haus grün".split()}


def sentence(rng, kind, n):
    return " ".join("".join(rng.choices(KINDS[kind], k=2)) + rng.choice("abcdefgh") for _ in range(n))


def table():
    rng = random.Random(21)
    item = sentence(random.Random(5), "aa", 18)
    rows = []
    for i in range(70):
        kind = "aa" if i % 3 else "bb"
        lines = [sentence(rng, kind, rng.randrange(8, 20)) for _ in range(rng.randrange(2, 5))]
        if i % 6 == 0:
            lines.append("this line stands in many documents of the table" + ("" if i % 12 else "!"))
        if i % 10 == 4:
            lines[0] += " " + (item if i % 20 == 4 else " ".join(item.split()[:12]))
        rows.append((i, "\n".join(lines), kind if i % 7 else None, f"s{i % 4}"))
    for k, i in enumerate((3, 8, 13)):  # near copies: one word of many, and the same without lines in common
        words = " ".join(t for j, t, *_ in rows if j in (i, i + 1, i + 2)).replace("\n", " ").split()
        rows.append((100 + k, " ".join(words), "aa", "s1"))
        rows.append((110 + k, " ".join([*words[:20], "changed", *words[21:]]), "aa", "s2"))
        rows.append((120 + k, " ".join(w for n, w in enumerate(words) if n % 9), "aa", "s2"))
    rows += [(200, None, "aa", "s0"), (201, "", "aa", "s0"), (202, "1 2 3", "aa", "s0"), (203, "this line stands in many documents of the table", None, None)]
    rows += [rows[1], (None, "the house of the green er and the tion of it", "aa", None), (2, "another text of the same id and the house of green", "aa", "s1")]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows], [(1, item), (2, None), (3, "...")]


def by_language(spark, rows, schema):
    known = langid.sample(spark.createDataFrame(rows, schema), "text", "lang", "doc_id")
    names = sorted({n for n, _ in known})
    kept = []
    for r in rows:
        if r[1] and any(c.isalpha() for c in r[1]):
            bits = np.array([slow_bits([t for n, t in known if n == name], r[1]) for name in names])
            if 1 / np.exp2(bits.min() - bits).sum() >= pipeline.LEAST_SCORE:
                kept.append(r)
    return kept


def by_line(rows):
    flat = [((r[0], p), x) for r in rows if r[0] is not None for p, x in enumerate(r[1].split("\n")) if len(x) >= 20]
    kept = []
    for r in rows:
        lines = r[1].split("\n")
        gone = [r[0] is not None and len(x) >= 20 and any(at < (r[0], p) and one_edit(x, y) for at, y in flat) for p, x in enumerate(lines)]
        text = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        if not any(gone) or text.strip(" "):
            kept.append((r[0], text, r[2], r[3], len(text) if any(gone) else r[4]))
    return kept


def by_copy(rows):
    known = [r for r in rows if r[0] is not None]
    parent = {r[0]: r[0] for r in known}
    for a in known:
        for b in known:
            if a[0] < b[0] and jaccard(a[1], b[1]) >= pipeline.SIMILAR:
                x, y = find(parent, a[0]), find(parent, b[0])
                parent[max(x, y)] = min(x, y)
    out = list(dict.fromkeys(r for r in known if find(parent, r[0]) == r[0]))
    return out + [r for r in rows if r[0] is None]


def by_benchmark(rows, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = {tuple(w[k : k + 13]) for _, t in items for w in [words(t)] if w for k in range(max(1, len(w) - 12))}
    kept = []
    for r in rows:
        w, hit = words(r[1]), set()
        for window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
        if not hit or (len(hit) < 13 and 20 * len(hit) < len(w)):
            kept.append(r)
    return kept


def by_weight(rows):
    topic = lambda t: next((n for n, part in mixing.TOPICS if part in t), "general")
    key = lambda r: (r[3] or "unknown", r[2] or "unknown", topic(r[1]))
    cells = Counter()
    for r in rows:
        cells[key(r)] += len(tokens(r[1]))
    total, factor = sum(cells.values()), dict.fromkeys(cells, 1.0)
    target = []
    for d, name in enumerate(mixing.DIMENSIONS):
        own = Counter()
        for c, n in cells.items():
            own[c[d]] += n
        raised = {v: n ** mixing.TEMPERATURES[name] for v, n in own.items()}
        target.append({v: x / sum(raised.values()) * total for v, x in raised.items()})
    for _ in range(400):
        for d in range(3):
            own = Counter()
            for c, n in cells.items():
                own[c[d]] += n * factor[c]
            factor = {c: f * target[d][c[d]] / own[c[d]] for c, f in factor.items()}
    low, high = 0.0, 1e6
    for _ in range(200):
        rate = (low + high) / 2
        low, high = (rate, high) if sum(n * min(1.0, rate * factor[c]) for c, n in cells.items()) < total / 2 else (low, rate)
    chance = lambda r: min(1.0, rate * factor[key(r)])
    unit = lambda i: int(hashlib.md5(f"17:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52
    return [(r[0], r[1], unit(r[0]) - chance(r)) for r in rows if tokens(r[1])]


def test_run_against_plain_python(spark, tmp_path):
    rows, items = table()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, docs = rows, spark.read.parquet(str(tmp_path / "documents.parquet"))
    key = lambda r: tuple(map(str, r))
    steps = [lambda r: by_language(spark, r, schema), by_line, by_copy, lambda r: by_benchmark(r, items)]
    for (name, stage), step in zip(pipeline.STAGES, steps, strict=False):
        kept = step(kept)
        docs = stage(spark, docs, str(tmp_path))
        got = docs.collect()
        assert sorted(map(key, got)) == sorted(map(key, kept)), name
        docs = spark.createDataFrame(got, schema)
    assert 20 < len(kept) < len(rows)
    drawn = by_weight(kept)
    assert min(abs(d) for *_, d in drawn) > 1e-4  # none is on the edge
    got = pipeline.run(spark, str(tmp_path))
    assert sorted((str(r.doc_id), r.text) for r in got.select("doc_id", "text").collect()) == sorted((str(i), t) for i, t, d in drawn if d < 0)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_take_empty_tables_and_columns_with_clashing_names(spark, tmp_path, name):
    rows, items = table()
    clash = "doc_id long, text string, lang string, source string, n_chars long, n_removed int, score string, topic int, f0 int, component_id string"
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(*r, 1, "s", 2, 3, "c") for r in rows[:12]], clash)
    stage = dict(pipeline.STAGES)[name]
    assert set(docs.columns) <= set(stage(spark, docs, str(tmp_path)).columns) and stage(spark, docs, str(tmp_path)).count() > 0
    assert stage(spark, docs.where(F.lit(False)), str(tmp_path)).count() == 0
