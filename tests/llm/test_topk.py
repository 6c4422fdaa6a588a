"""Top-k against all pairs."""

import math

import numpy as np
import pytest
from llm.support import rows

from loanscope.llm import topk
from loanscope.llm.topk import KdTree, top_k

SCHEMA = "vec_id long, embedding array<double>"


def brute(data, k, every=100):
    ints = {}
    out = []
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in data
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    for i, v in usable:
        ints.setdefault((i, tuple(v)), 0)
    for i, v in ints:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def check(spark, data, k=10, every=100, schema=SCHEMA, **kw):
    got = rows(top_k(spark.createDataFrame(data, schema), k, query_every=every, **kw))
    assert sorted(got) == brute(data, k, every)


@pytest.mark.parametrize("shard_rows", [50, 300, 10_000])
def test_random_vectors(spark, shard_rows):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=6).round(2).tolist()) for i in range(900)]
    check(spark, data, shard_rows=shard_rows)


def test_ties_and_repeated_rows(spark):
    same = [(i, [1.0, 0.0]) for i in range(200)]
    check(spark, same + same[:3] + [(400, [1.0, 0.0])], shard_rows=40)


def test_one_id_in_most_rows(spark):
    rng = np.random.default_rng(3)
    data = [(100 if i % 3 else i, rng.normal(size=3).round(2).tolist()) for i in range(600)]
    check(spark, data, k=3, shard_rows=100)
    shard = topk._shard(6)
    sizes = spark.createDataFrame(data, "vec_id long, vector array<double>").groupBy(shard).count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 200


def test_one_vector_in_most_rows(spark):
    rng = np.random.default_rng(2)
    data = [(i, [0.5, -0.25, 0.125] if i % 3 else rng.normal(size=3).tolist()) for i in range(3000)]
    check(spark, data, every=300, shard_rows=500)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [9.0, 9.0]), (5, [3.0, 1.0]),
        (100, None), (200, [nan, 0.0]), (7, []), (300, []), (8, [1.0]),
    ]
    check(spark, data)


def test_few_candidates_and_empty_table(spark):
    check(spark, [(0, [1.0])])
    check(spark, [(0, [1.0]), (1, [-1.0])], k=10)
    check(spark, [])


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(3)
    for size in (1e3, 2e5):
        check(spark, [(i, (rng.normal(size=4) * size).tolist()) for i in range(300)], shard_rows=100)


def test_scores_beyond_a_long_are_its_ends(spark):
    df = spark.createDataFrame([(0, [1e9]), (1, [1e9]), (2, [-1e9]), (3, [1e300])], SCHEMA)
    assert rows(top_k(df)) == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 2**63 - 1), (0, 3, 2, -(2**63))]


def test_extra_columns(spark):
    data = [(i, [float(i % 7)], 1, 2) for i in range(120)]
    df = spark.createDataFrame(data, SCHEMA + ", score int, shard int")
    assert sorted(rows(top_k(df))) == brute([d[:2] for d in data], 10)


def test_the_tree_looks_at_few_leaves():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(20_000, 3))
    tree = KdTree(points, np.arange(20_000))
    query = rng.normal(size=3)
    seen = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            seen.append(key)
            return np.ndarray.__getitem__(self, key)

    tree.points = tree.points.view(Counting)
    ids, _ = tree.search(query, tree.bounds(query[None])[0], -1, 10, None)
    assert ids.tolist() == np.argsort(-(points @ query))[:10].tolist()
    assert len(seen) < 20_000 / topk.LEAF / 4
