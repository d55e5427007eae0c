"""The trie of rebuilt conversations against sequences of turns in plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from docforge.llm import trie
from docforge.llm.queries import op13_conversation_trie


def brute(rows, every=20, most=4):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (c % every if c >= 0 else -(-c % every))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for path, convs in members.items():
        under = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p)
        leaves = sum(not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in under) for p in under)
        children = sum(len(p) == len(path) + 1 for p in under)
        ends = ",".join(map(str, sorted(c for c in convs if rebuilt[c] == path)))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def have(df, **options):
    return sorted((tuple(r) for r in trie.conversation_trie(df, **options).collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(4))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    convs = [*range(45), 100, 2**40, -5, -20, -21] if seed else list(range(0, 400, 3))
    rows = []
    for c in convs:
        turns = list(range(rng.randint(1, 6)))
        if rng.random() < 0.3:
            turns[0] = None
        rows += [(c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b c", "", None, "d e  f"])) for t in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert have(df) == brute(rows)
    assert have(df, every=7, most=2) == brute(rows, 7, 2)


def test_copies_and_prefixes(spark):
    turns = [(t, "user", f"w{t} x") for t in range(150)]
    rows = [(20 * c, *t) for c in (1, 2, 3) for t in turns[:8]]  # copies
    rows += [(20 * c, *t) for c, n in ((4, 7), (5, 3), (6, 150), (7, 1)) for t in turns[:n]]  # prefixes, and one that goes on
    rows += [(None, 0, "user", "nobody")]
    assert have(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_hot_conversation_over_many_tasks(spark):
    rows = [(40, t, "user", f"t{t} {t % 7}") for t in range(3000)] + [(c, t, "user", "x y") for c in range(41, 60) for t in range(4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = {(r.conv_id, r.at): r.upto for r in trie._numbered(spark.createDataFrame(rows, SCHEMA).repartition(9)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [own[40, t] for t in range(3000)] == [2 * (t + 1) for t in range(3000)] and len(own) == len(rows)


def test_nothing_and_one(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert have(none) == []
    one = [(3, None, None, None)]
    assert have(spark.createDataFrame(one, SCHEMA)) == brute(one)
    turnless = [(c, 0, "user", "gone") for c in range(1, 20)]
    extra = spark.createDataFrame([(*r, 1, 2) for r in turnless], f"{SCHEMA}, depth int, n_convs int")
    assert have(extra) == brute(turnless)


def test_rows_that_repeat_a_turn(spark):
    rows = [(40, 0, "user", "a"), (40, 0, "user", "a"), (40, 0, "user", "b"), (20, 5, "user", "z" * 3_000_000), (20, 5, "user", "z" * 3_000_000)]
    found = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))
    assert found.where("depth = 0").first().n_convs == 2 and found.where("n_children = 0").count() == 2


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op13_conversation_trie(spark, "/root/testdata/sf0.001")
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)
