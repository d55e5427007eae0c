"""The registered corpus queries without SQL, held row by row against plain Python on the smallest tables."""

import hashlib
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash

from docforge.llm import queries as corpus

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="tables are not there")
SPACES = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{DATA}/{t}.parquet").select(*c).collect()]
    return {
        "docs": sorted(read("documents", "doc_id", "text", "lang")), "items": read("benchmark", "item_id", "text"), "vectors": dict(read("embeddings", "vec_id", "embedding")), "labels": dict(read("labels", "doc_id", "toxic"))
    }


def rows(spark, name):
    return corpus.queries()[name](spark, str(DATA)).collect()


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_op2(spark, tables):
    ids = np.array(sorted(tables["vectors"]))
    matrix = np.array([tables["vectors"][i] for i in ids], np.float64)
    found = {}
    for r in rows(spark, "op2_nearest_neighbours"):
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(found) == [i for i in ids if i % 20 == 0]
    hits = 0
    for q, got in found.items():
        scores = matrix @ matrix[ids == q][0]
        got = sorted(got)
        assert [k for k, _, _ in got] == list(range(1, 21)) and q not in {v for _, v, _ in got} and len({v for _, v, _ in got}) == 20
        assert [v for _, v, _ in got] == [v for _, v in sorted((-s, v) for _, v, s in got)]
        assert np.allclose([s for _, _, s in got], [scores[ids == v][0] for _, v, _ in got], rtol=1e-12, atol=1e-12)
        hits += len({v for _, v, _ in got} & set(ids[np.lexsort((ids, -np.where(ids == q, -np.inf, scores)))][:20]))
    assert hits >= 0.9 * 20 * len(found)


def test_op3(spark, tables):
    words = {i: SPACES.findall((t or "").encode()) for i, t, _ in tables["docs"]}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    want = []
    for i, own in words.items():
        gone = np.zeros(len(own), bool)
        for k in range(len(own) - 12):
            if first[tuple(own[k : k + 13])] < i:
                gone[k : k + 13] = True
        want.append((i, len(own), int(gone.sum()), sha(b" ".join(w for w, g in zip(own, gone, strict=True) if not g))))
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows(spark, "op3_substring_dedup")) == sorted(want)


def test_op5(spark, tables):
    prints = {}
    for i, t, _ in tables["docs"]:
        words = SPACES.findall((t or "").translate({c: c + 32 for c in range(65, 91)}).encode())
        shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        h = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
        bits = ((h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(0) if len(h) else np.zeros(64)
        prints[i] = sum(1 << b for b in range(64) if 2 * bits[b] > len(h))
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows(spark, "op5_simhash")) == [(i, f"{prints[i]:016x}", top(i)) for i in ids]


def test_op10(spark, tables):
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))
    windows = {}
    for i, t in tables["items"]:
        words = split(t)
        for k in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[k : k + 13]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    want = []
    for i, t, _ in tables["docs"]:
        words, items = split(t), set()
        hit = np.zeros(len(words), bool)
        for n in sizes:
            for k in range(len(words) - n + 1):
                of = windows.get(tuple(words[k : k + n]))
                if of:
                    hit[k : k + n] = True
                    items |= of
        n = int(hit.sum())
        want.append((i, len(words), n, len(items), sha(",".join(sorted(items)).encode()), n > 0 and 20 * n >= len(words)))
    assert sorted(tuple(r) for r in rows(spark, "op10_decontamination")) == sorted(want)


def test_op4(spark, tables):
    texts = {i: t for i, t, _ in tables["docs"]}
    forward, back, many = {}, {}, 0
    for r in rows(spark, "op4_pii_surrogates"):
        out, at = [], 0
        assert r.n_entities == len(r.entities)
        for e in r.entities:
            old = texts[r.doc_id][e.start : e.end]
            assert e.surrogate != old
            case = str.lower if e.kind == "email" else lambda v: re.sub(r"\D", "", v)[-10:] if e.kind == "phone" else re.sub(r"\D", "", v) if e.kind in ("card", "ssn") else v  # noqa: B023
            assert forward.setdefault((e.kind, case(old)), case(e.surrogate)) == case(e.surrogate)
            assert back.setdefault((e.kind, case(e.surrogate)), case(old)) == case(old)
            out += [texts[r.doc_id][at : e.start], e.surrogate]
            at, many = e.end, many + 1
        assert r.text == (None if texts[r.doc_id] is None else "".join([*out, texts[r.doc_id][at:]]))
    assert many > 20


def test_op6_and_op8(spark, tables):
    langs = {l for _, _, l in tables["docs"] if l}
    texts = {i: (t or "", l) for i, t, l in tables["docs"]}
    right = known = 0
    for r in rows(spark, "op6_language_id"):
        text, lang = texts[r.doc_id]
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1
        assert r.lang_pred == "und" if not any(c.isalpha() for c in text) else r.lang_pred in langs
        if r.held_out and lang and len(text) > 40:
            right, known = right + (r.lang_pred == lang), known + 1
    assert right >= 0.9 * known
    for r in rows(spark, "op8_toxicity"):
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
