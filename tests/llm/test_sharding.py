"""Shards: sizes, checksums, counts and mixture."""

import hashlib
import zlib
from collections import Counter

import pytest
from llm.support import DOCS, ODD_TEXTS, SMALL, docs, rows, small

from loanscope.llm.queries import op7_sharding
from loanscope.llm.sharding import assign_shards, write_shards


def check(table, placed, n_shards):
    """Every row once, whole texts, counts at most one apart, slots without gaps."""
    want = sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in table), key=repr
    )
    assert sorted((tuple(r)[:3] for r in placed), key=repr) == want
    counts = Counter(r["shard"] for r in placed)
    assert set(counts) <= set(range(n_shards))
    sizes = [counts.get(s, 0) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in placed if r["shard"] == shard) == list(range(counts[shard]))


def test_query(spark):
    placed = op7_sharding(spark, SMALL).collect()
    check([(r["doc_id"], r["text"]) for r in small("documents")], placed, 40)
    assert {(r["law"], r["grown_shard"]) for r in placed} == {("rows", None)}


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_every_shard_matches_the_mixture(spark, buckets):
    n = 3000
    sources = ["hot" if i % 3 else f"s{i % 17}" for i in range(n)]
    df = docs(spark, [f"t{i % 50}" for i in range(n)], source=sources).repartition(7)
    placed = assign_shards(df, 11, buckets=buckets).collect()
    check([(i, f"t{i % 50}") for i in range(n)], placed, 11)
    total = Counter(sources)
    by_shard = Counter((r["shard"], sources[r["doc_id"]]) for r in placed)
    for shard in range(11):
        for source, count in total.items():
            assert abs(by_shard[shard, source] - count / 11) <= 3, (shard, source)


def test_the_order_follows_the_rule(spark):
    """A plain account: rank by seeded hash within each source, then sort by fraction."""
    sources = ["a"] * 30 + ["b"] * 7 + [None] * 3
    placed = assign_shards(docs(spark, ["x"] * 40, source=sources), 1, seed=5).collect()
    key = {i: hashlib.md5(f"5|{i}".encode()).hexdigest() for i in range(40)}
    fractions = []
    for name in ("a", "b", None):
        own = sorted((i for i in range(40) if sources[i] == name), key=key.get)
        stratum = "" if name is None else "=" + name
        offset = ((int(hashlib.md5(f"5|{stratum}".encode()).hexdigest()[:8], 16) >> 16) + 0.5) / 65536
        fractions += [((r + offset) / len(own), stratum, i) for r, i in enumerate(own)]
    assert [r["doc_id"] for r in sorted(placed, key=lambda r: r["slot"])] == [i for _, _, i in sorted(fractions)]


def test_one_id_in_most_rows(spark):
    ids, texts = [i if i % 3 == 0 else None for i in range(600)], [f"t{i}" for i in range(600)]
    df = docs(spark, texts, doc_id=ids, source=["a", "b"] * 300)
    placed = assign_shards(df, 7, buckets=64)
    assert "text_crc32" in placed.columns and "part" not in placed.columns
    check(list(zip(ids, texts)), placed.collect(), 7)
    # Equal ids are ranked in parts by their texts, whatever the order of the rows.
    again = assign_shards(df.repartition(5), 7, buckets=64)
    assert rows(again) == rows(placed)
    order = [r for r in sorted(assign_shards(df.where("source = 'a'"), 1, buckets=64).collect(), key=lambda r: r["slot"])]
    parts = [r["text_crc32"] * 64 >> 32 for r in order if r["doc_id"] is None]
    assert parts == sorted(parts)


def test_seeds_differ(spark):
    df = docs(spark, ["x"] * 100)
    order = [[r["doc_id"] for r in sorted(assign_shards(df, 1, s).collect(), key=lambda r: r["slot"])] for s in (0, 1, 0)]
    assert order[0] == order[2] != order[1]


def test_odd_rows(spark):
    ids = [*range(len(ODD_TEXTS)), None, None, 0]
    texts = [*ODD_TEXTS, None, "z", ODD_TEXTS[0]]
    df = docs(spark, texts, doc_id=ids, source=[None, "a", ""] * 20).selectExpr("*", "1 AS shard", "'x' AS size", "2 AS bucket")
    check(list(zip(ids, texts)), assign_shards(df, 5).collect(), 5)


def test_fewer_rows_than_shards_and_none(spark):
    check([(0, "a"), (1, "b")], assign_shards(docs(spark, ["a", "b"]), 40).collect(), 40)
    assert assign_shards(spark.createDataFrame([], DOCS), 40).collect() == []
    with pytest.raises(ValueError):
        assign_shards(docs(spark, ["a"]), 0)


def test_written_shards(spark, tmp_path):
    df = docs(spark, [f"t{i}" for i in range(50)])
    write_shards(df, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert rows(back.select(*df.columns)) == rows(df)
    assert Counter(r["shard"] for r in back.collect()) == {0: 13, 1: 12, 2: 13, 3: 12}
