"""Simple-8b files: round trips, and the registered query against the tokenizer on whole texts."""

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from docforge.llm import idfiles
from docforge.llm.queries import op12_token_ids

P = pytest.importorskip("public_tokenizers")
BYTES = P.path("byte_bpe_50k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=400), st.sampled_from([1, 7, 64, 1024]))
def test_words_and_back(values, block):
    ids = np.array(values, np.uint64)
    words, starts = idfiles.encode(ids, block)
    assert (idfiles.decode(words, starts) == ids).all() and len(starts) == -(-len(ids) // block) + 1
    for k in range(len(starts) - 1):  # each block on its own
        part = idfiles.decode(words[starts[k] : starts[k + 1]], starts[k : k + 2] - starts[k])
        assert (part == ids[k * block : (k + 1) * block]).all()


def test_how_words_are_packed():
    words, starts = idfiles.encode(np.array([1, 0, 1, 5, 2**60], np.uint64))
    assert [int(w) & 0xFFFFFFFF for w in words[:1]] == [5] and int(words[0]) >> 32 == 1
    assert [int(w) >> 60 for w in words[1:-1]] == [11, idfiles.ESCAPE] and int(words[-1]) == 2**60  # four ids in 15 bits each, then an escape
    assert len(idfiles.encode(np.zeros(120, np.uint64))[0]) == 3
    with pytest.raises(ValueError, match="damaged"):
        idfiles.decode(np.array([1, 0], np.uint64), np.array([0, 2]))


def test_shards_read_any_run(tmp_path):
    system, path = fs.LocalFileSystem(), str(tmp_path / "a.s8b")
    rng, docs = np.random.default_rng(2), []
    shard = idfiles.ShardWriter(system, path)
    for i in range(300):
        ids = rng.integers(0, 50257, rng.integers(1, 9000) if i % 50 else 1_200_000).astype(np.uint32)
        docs.append(ids)
        shard.add(None if i == 0 else i, ids.tobytes())
    name, n_docs, n_ids = shard.close()
    every = np.concatenate(docs)
    reader = idfiles.ShardReader(system, path)
    assert (name, n_docs, n_ids) == ("a.s8b", 300, len(every)) and reader.missing.tolist() == [True] + [False] * 299
    assert (np.concatenate([ids for _, ids in reader.runs()]) == every).all()
    for start, stop in ((0, 1), (1023, 1025), (5000, 1_300_000), (len(every) - 1, len(every)), (7, 7)):
        assert (reader.ids(start, stop) == every[start:stop]).all()
    (tmp_path / "bad").write_bytes(b"x" * 100)
    with pytest.raises(ValueError, match="no file of ids"):
        idfiles.ShardReader(system, str(tmp_path / "bad"))


TEXTS = st.text(st.one_of(st.sampled_from(" \n\t.,!'s1éü᠎　\x1c\x85"), st.characters(exclude_categories=["Cs"])), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_pieces_give_the_ids_of_whole_texts(texts):
    encoder = idfiles.encoder(open(BYTES, encoding="utf-8").read())
    assert encoder.by_pieces
    every = [*texts, "a<|endoftext|>b <|endoftext|>", "word " * 50 + " \n\n x", "it's we'LL", "", " a", "a b  c", "x \ty z"]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in every]
    assert ["".join(idfiles.PIECE.findall(t)) for t in every] == every
    assert [np.frombuffer(encoder.encode(t), np.uint32).tolist() for t in every] == want


def test_other_tokenizers_get_whole_texts():
    encoder = idfiles.Encoder(open(P.path("word_bpe_49k.json"), encoding="utf-8").read())
    assert not encoder.by_pieces
    for text in ("A  b.", "", "c"):
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(idfiles, "REMEMBERED", 5)
    encoder = idfiles.Encoder(open(BYTES, encoding="utf-8").read())
    for text in ("a b c d e", "a b c f g. h, i j", "k l m n. o p q r s t u", "a b c k l m", "a " * 30):
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.parts) <= 5 + 11 and len(encoder.pieces) <= 5 + 20


def test_shards_end_with_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(idfiles, "SHARD_DOCS", 3)
    folder, system = str(tmp_path), fs.LocalFileSystem()
    shard = idfiles.ShardWriter(system, f"{folder}/a")
    for i in range(5):
        shard.add(i, np.arange(i, dtype=np.uint32).tobytes())
    assert shard.close() == ("a", 5, 10) and idfiles.ShardReader(system, f"{folder}/a").sizes.tolist() == [0, 1, 2, 3, 4]


def brute(rows, end):
    tokenizer, start, out = Tokenizer.from_file(BYTES), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_rows_of_every_kind(spark, tmp_path, monkeypatch):
    rows = [(5, "five words of some text"), (-3, None), (2, ""), (9, "long " * 400_000), (4, "é\n\n  x")]
    df = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id int, start int").repartition(3)
    manifest = idfiles.write_ids(df, BYTES, f"file://{tmp_path}/ids", end_id=2)
    want = brute(sorted(rows), 2)
    assert sorted(tuple(r) for r in idfiles.read_counts(manifest).collect()) == sorted(want)
    whole = {r.doc_id: (r.start, r.ids) for r in idfiles.read_ids(manifest).collect()}
    assert {k: (s, len(i)) for k, (s, i) in whole.items()} == {k: (s, n) for k, s, n, _ in want} and whole[2][1] == [2]
    # null ids first, repeated ids one after the other
    odd = spark.createDataFrame([(None, "b"), (1, "x"), (1, "y y"), (1, "x"), (0, "z")], "doc_id long, text string")
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in idfiles.read_counts(idfiles.write_ids(odd, BYTES)).collect())
    assert [g[1] for g in got] == [None, 0, 1, 1, 1] and [g[0] for g in got] == [0, 2, 4, *np.cumsum([g[2] for g in got])[2:4].tolist()]
    empty = idfiles.write_ids(odd.limit(0), BYTES)
    assert empty.count() == 0 == idfiles.read_counts(empty).count()


def test_files_without_a_manifest_entry_go(spark, tmp_path):
    (tmp_path / "part-000009-000000-lost.s8b").write_bytes(b"half")
    manifest = idfiles.write_ids(spark.createDataFrame([(1, "a")], "doc_id long, text string"), BYTES, str(tmp_path))
    assert [p.name for p in tmp_path.iterdir() if p.suffix == ".s8b"] == [manifest.first().file]


def test_registered_query(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    have = [tuple(r) for r in op12_token_ids(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()]
    assert have == brute(rows, 2)
