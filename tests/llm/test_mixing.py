"""Mixtures against a plain search, and draws against their budgets."""

import hashlib
import math
import random
from collections import Counter

import pytest
from llm.support import DOCS, ODD_TEXTS, WORD, docs, rows

from loanscope.llm import mixing
from loanscope.llm.mixing import count_tokens, draw, mix, mixture, repeat_to_weights


def n_tokens(text):
    return len(WORD.findall(text or ""))


def weights(tokens, a):
    total = sum(tokens.values())
    powers = {s: (t / total) ** a if t else 0.0 for s, t in tokens.items()}
    return {s: p / sum(powers.values()) for s, p in powers.items()}


def entropy_of(w):
    return -sum(x * math.log(x) for x in w.values() if x)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    sizes = {"hot": 300, "b": 60, "c": 25, None: 10, "e": 3}
    out = []
    for source, n in sizes.items():
        out += [(source, " ".join(["w"] * rng.randint(1, 40))) for _ in range(n)]
    rng.shuffle(out)
    return out


def frame(spark, corpus):
    return docs(spark, [t for _, t in corpus], source=[s for s, _ in corpus]).repartition(3)


def totals(corpus):
    out = Counter()
    for s, t in corpus:
        out[s] += n_tokens(t)
    return out


@pytest.mark.parametrize("entropy, repeats", [(0.7, None), (0.95, None), (None, 1.5), (0.95, 1.5), (1.0, None), (0.01, 3.0), (None, None)])
def test_exponent_by_plain_bisection(spark, corpus, entropy, repeats):
    tokens = totals(corpus)
    plan = mixture(count_tokens(frame(spark, corpus)), entropy, repeats, 1.0).collect()
    n, total = len(tokens), sum(tokens.values())

    def fits(a):
        w = weights(tokens, a)
        return repeats is None or max(w[s] * total / tokens[s] for s in tokens) <= repeats

    def even(a):
        return entropy is None or entropy_of(weights(tokens, a)) >= entropy * math.log(n)

    low, high = 0.0, 1.0
    if entropy is None:
        exponent = 0.0 if repeats is not None else 1.0
    elif even(1.0):
        exponent = 1.0
    else:
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if even(middle) else (low, middle)
        exponent = low
    if not fits(exponent):
        low, high = exponent, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if fits(middle) else (middle, high)
        exponent = high
    assert plan[0]["exponent"] == pytest.approx(exponent, abs=3e-6)
    want = weights(tokens, plan[0]["exponent"])
    assert {r["source"]: r["weight"] for r in plan} == pytest.approx(want, abs=1e-8)
    assert sum(r["weight"] for r in plan) == pytest.approx(1, abs=1e-7)


def test_repeats_without_a_budget(spark, corpus):
    """The repeats of the small sources are limited when the largest is drawn once."""
    plan = mixture(count_tokens(frame(spark, corpus)), 0.99, 2.0, None).collect()
    repeats = {r["source"]: r["target"] / r["tokens"] for r in plan}
    assert min(repeats.values()) == pytest.approx(1, abs=0.01) and repeats["hot"] == min(repeats.values())
    assert max(repeats.values()) == pytest.approx(2.0, abs=0.05)


@pytest.mark.parametrize("budget", [0.1, 1.0, 3.7])
def test_draws_meet_their_budget(spark, corpus, budget):
    counted = count_tokens(frame(spark, corpus))
    plan = {r["source"]: r for r in mixture(counted, 0.9, 4.0, budget).collect()}
    drawn = mix(frame(spark, corpus), 0.9, 4.0, budget).collect()
    longest = {s: max(n_tokens(t) for x, t in corpus if x == s) for s in plan}
    for source, row in plan.items():
        own = [d for d in drawn if d["source"] == source]
        tokens = sum(d["n_tokens"] for d in own)
        assert row["target"] - longest[source] < tokens <= row["target"]
        blocks = Counter(d["block"] for d in own)
        whole = row["target"] // row["tokens"]
        size = sum(s == source for s, _ in corpus)
        assert all(blocks[b] == size for b in range(whole)) and set(blocks) <= set(range(whole + 1))
        assert len({(d["doc_id"], d["block"]) for d in own}) == len(own)


@pytest.mark.parametrize("buckets", [1, 5, 65_536])
def test_the_last_block_is_the_start_of_a_permutation(spark, corpus, buckets):
    counted = count_tokens(frame(spark, corpus))
    plan = mixture(counted, 0.9, 4.0, 1.0)
    drawn = draw(counted, plan, 3, buckets=buckets).collect()
    for row in plan.collect():
        source, whole = row["source"], row["target"] // row["tokens"]
        own = [(i, n_tokens(t)) for i, (s, t) in enumerate(corpus) if s == source]
        keyed = [(hashlib.md5(f"3|{whole}|{i}".encode()).hexdigest(), i, n) for i, n in own]
        left, want = row["target"] % row["tokens"], []
        for key, i, n in sorted(keyed):
            left -= n
            if left < 0:
                break
            want.append((i, key))
        got = [(d["doc_id"], d["draw_key"]) for d in drawn if d["source"] == source and d["block"] == whole]
        assert sorted(got) == sorted(want)


def test_one_id_in_most_rows(spark):
    df = docs(spark, ["a b"] * 400, doc_id=[i if i % 4 == 0 else None for i in range(400)], source=["x"] * 300 + ["y"] * 100)
    counted = count_tokens(df)
    lean = mixing._documents(counted.selectExpr("source AS stratum", "doc_id", "n_tokens"))
    assert lean.count() == 102 and lean.agg({"n_tokens": "sum"}).first()[0] == 800
    for row in mixture(counted, 0.99, 4.0, 1.0).collect():
        drawn = [d for d in mix(df, 0.99).collect() if d["source"] == row["source"]]
        assert sum(d["n_tokens"] for d in drawn) <= row["target"]
        missing = Counter(d["block"] for d in drawn if d["doc_id"] is None)
        assert set(missing.values()) <= {225 if row["source"] == "x" else 75}  # all or none


def test_repeating_loses_no_document(spark, corpus):
    df = frame(spark, corpus).selectExpr("*", "1 AS block", "2 AS n_tokens", "3 AS weight")
    out = repeat_to_weights(df, 0.95, 4.0)
    assert out.schema == df.schema
    assert set(rows(out)) == set(rows(df))
    got, tokens = Counter(), totals(corpus)
    for r in out.collect():
        got[r["source"]] += n_tokens(r["text"])
    share = {s: x / sum(got.values()) for s, x in got.items()}
    before = {s: x / sum(tokens.values()) for s, x in tokens.items()}
    assert entropy_of(share) > entropy_of(before) + 0.1
    assert max(got[s] / tokens[s] for s in tokens) <= 4


def test_odd_rows(spark):
    ids = [*range(len(ODD_TEXTS)), None, 0]
    df = docs(spark, [*ODD_TEXTS, None, ODD_TEXTS[0]], doc_id=ids, source=[None, "a", "", "b", "b"] * 20)
    assert Counter(rows(repeat_to_weights(df))).keys() == Counter(rows(df)).keys()
    drawn = mix(df).collect()
    assert sum(d["n_tokens"] for d in drawn) <= sum(map(n_tokens, ODD_TEXTS))


def test_sources_without_tokens_and_empty_tables(spark):
    df = docs(spark, ["", None, "a b"], source=["x", "x", "y"])
    assert sorted(d["doc_id"] for d in mix(df).collect()) == [0, 1, 2]
    nothing = docs(spark, ["", None], source=["x", None])
    assert len(mix(nothing).collect()) == 2 and len(repeat_to_weights(nothing).collect()) == 2
    empty = spark.createDataFrame([], DOCS)
    assert mix(empty).collect() == [] and repeat_to_weights(empty).collect() == []


def test_only_spark_functions(spark, corpus):
    plan = mix(frame(spark, corpus))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_columns_of_any_name_and_type(spark):
    extra = ["1 AS stratum", "2 AS bucket", "3 AS block", "4 AS row", "5 AS last_key", "6 AS weight", "7 AS `a.b`", "map(1, doc_id) AS m"]
    df = docs(spark, ["a b", "c d e", "f"], source=["x", "y", None]).selectExpr("*", *extra)
    out = repeat_to_weights(df)
    assert out.schema == df.schema
    assert {repr(r) for r in out.collect()} == {repr(r) for r in df.collect()}
