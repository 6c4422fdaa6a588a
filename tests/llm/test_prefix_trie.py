"""The trie of rebuilt conversations, against plain lists of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm.support import SMALL, rows, small

from loanscope.llm import prefix_trie as module
from loanscope.llm.prefix_trie import DoubleArray, _numbered, cut_paths, prefix_trie, trie_nodes
from loanscope.llm.queries import op13_prefix_trie

TURNS = "conv_id long, turn int, role string, text string"


def plain(table):
    own = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5
        built[c] = (*own.get(c - (rest if c >= 0 else -rest), [])[:h], *turns[h:])
    return nodes(built)


def nodes(built):
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(convs), len(p), parent, len(convs), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(n, seed=0, most=6, words=4):
    """Turns of few different texts, so that conversations share beginnings."""
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for turn in range(rng.randint(0, most)):
            out.append((c, turn, ("user", "assistant")[turn % 2], f"t{rng.choice([0, 0, 0, *range(words)])}é"))
    return out


def test_query(spark):
    assert rows(op13_prefix_trie(spark, SMALL)) == plain([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in small("conversations")])


@pytest.mark.parametrize("shard_paths", [1, 3, 40, 10_000])
def test_shards_make_no_difference(spark, shard_paths):
    table = conversations(300)
    assert rows(prefix_trie(spark.createDataFrame(table, TURNS).repartition(5), shard_paths)) == plain(table)


def test_a_hot_first_turn_and_a_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(module, "TURN_BUCKET", 16)
    rng = random.Random(4)
    table = conversations(60, 5)
    table += [(c, t, "user", "hello" if t == 0 else f"x{rng.random()}") for c in range(100, 300) for t in range(3)]
    table += [(c, t, "user", f"copy{t}") for c in range(1000, 1200) for t in range(4)]
    table += [(7, t, "user", f"long{t}") for t in range(-50, 100)]
    df = spark.createDataFrame(table, TURNS)
    assert rows(prefix_trie(df, 25)) == plain(table)


def test_paths_that_agree_beyond_the_turns_of_a_cut(spark, monkeypatch):
    monkeypatch.setattr(module, "CUT_TURNS", 2)
    table = [(c, t, "u", "same" if t < 12 else f"{c}") for c in range(90) for t in range(13)] + conversations(80, 8, 9)
    assert rows(prefix_trie(spark.createDataFrame(table, TURNS), 4)) == plain(table)


def test_id_buckets(spark, monkeypatch):
    monkeypatch.setattr(module, "ID_BUCKET", 7)
    monkeypatch.setattr(module, "TURN_BUCKET", 2)
    table = [(c, t, "u", f"{t}") for c in range(-50, 120) for t in range(7)]
    assert rows(prefix_trie(spark.createDataFrame(table, TURNS), 3)) == plain(table)


def test_odd_rows(spark):
    table = [
        (None, 0, "user", "a"), (1, None, None, None), (1, None, "", ""), (1, 0, "user", "a"), (1, 0, "user", "a"),
        (2, 3, "user", "b"), (2, 3, "a", "b"), (2, -1, None, "x"), (-4, 0, "u", "y"), (-1, 0, "u", "y"), (-1, 2**31 - 1, "u", "z" * 100_000),
        (5, 0, "us", "era"), (6, 0, "user", "a"), (2**62, 0, "", "日本"), (10, 0, "\x00", "\n"),
    ]
    df = spark.createDataFrame(table, TURNS).selectExpr("*", "1 AS place", "'x' AS path", "2 AS shard", "map(1, 2) AS `a.b`")
    assert rows(prefix_trie(df)) == plain(table)


def test_no_rows(spark):
    assert prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect() == []


def test_cuts_are_bounded_and_ascending(spark):
    members = spark.range(500).selectExpr("id AS conv_id", "unhex(repeat(md5(CAST(id AS STRING)), 5 * CAST(id % 3 AS INT))) AS path")
    distinct = members.groupBy("path").agg({"conv_id": "min"})
    cuts = cut_paths(distinct, 20)
    assert cuts == sorted(set(cuts)) and 1 <= len(cuts) <= 500 // 20 + 1
    assert cut_paths(distinct, 1000) == []


@pytest.mark.parametrize("seed", range(4))
def test_double_array(seed):
    """Slots are taken once, every path leads to its own end, and CHECK leads back."""
    rng = random.Random(seed)
    turns = [bytes(rng.randrange(256) for _ in range(20)) for _ in range(rng.choice([2, 30, 400]))]
    found = sorted({b"".join(rng.choices(turns, k=rng.randint(0, 5))) for _ in range(500)})
    lengths, ids, offsets = _numbered(found)
    assert len(set(ids.tolist())) == len({p[i : i + 20] for p in found for i in range(0, len(p), 20)})
    trie = DoubleArray(lengths, ids, offsets)
    ends = trie.ends()
    assert len(set(ends.tolist())) == len(found)
    used = np.concatenate(trie.levels())
    prefixes = {p[:i] for p in found for i in range(0, len(p) + 1, 20)}
    assert len(used) == len(prefixes) and (trie.check[used] != -2).all()
    for path, slot in zip(found, ends.tolist()):
        for depth in range(len(path) // 20, 0, -1):
            assert trie.level[slot] == depth
            slot = int(trie.check[slot])
        assert slot == 0


def test_members_given_as_paths(spark):
    """The general interface: any paths of turn digests and lengths."""
    rows_of = [(1, b"a" * 16 + (3).to_bytes(4, "big")), (2, b"a" * 16 + (3).to_bytes(4, "big")), (3, b"")]
    got = rows(trie_nodes(spark.createDataFrame(rows_of, "conv_id long, path binary")))
    assert got == nodes({1: (("", "xxx"),), 2: (("", "xxx"),), 3: ()})
