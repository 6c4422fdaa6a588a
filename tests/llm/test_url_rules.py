"""Url rules against a plain loop over all rules."""

import random

import pytest
from llm.support import rows

from loanscope.llm.url_rules import apply_rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return rest[:end].translate(LOWER), path[:stop]


def judge(url, rules, default="allow"):
    host, path = split(url)
    best = max(
        (
            (len(h) + len(p), len(h), verdict == "block", h + p, verdict)
            for h, p, verdict in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ),
        default=None,
    )
    return (host, path, best and best[3], best[4] if best else default)


def check(spark, urls, rules, **kw):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rule_rows = spark.createDataFrame(rules, "host string, path string, verdict string")
    want = sorted(((i, *judge(u, rules)) for i, u in enumerate(urls)), key=repr)
    assert rows(apply_rules(df, rule_rows, **kw)) == want


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_random_rules_and_urls(spark, ranges):
    rng = random.Random(ranges)
    labels = ["a", "b", "ab", "com", "net"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    def path():
        return "".join("/" + rng.choice(["x", "y", "xy", ""]) for _ in range(rng.randint(0, 3)))

    rules = sorted({(host(), path(), rng.choice(["allow", "block"])) for _ in range(120)})
    urls = [f"http://{'a.com' if rng.random() < 0.4 else host()}{path()}{rng.choice(['', '?q=/x', '#f'])}" for _ in range(1500)]
    check(spark, urls, rules, ranges=ranges)


def test_odd_urls(spark):
    rules = [("com", "/", "block"), ("example.com", "", "allow"), ("a.b", "/p", "block")]
    urls = [
        None, "", "x", "://", "http://", "http://com", "http://COM/", "HTTP://www.Example.COM", "http://xcom/", "http://a..com/",
        "http://.com/", "http://a.b:80/p", "ftp://a.b/pq?/p#://com/", "http://x/://com/", "http://com?/", "http://com#/", "http://é.com/É",
        "a://b://com/", "http://a.b/p\nq", "http://com./", "x" * 3000 + "://com/" + "y" * 3000,
    ]
    check(spark, urls, rules)


def test_rules_that_fit_nothing_or_everything_on_a_host(spark):
    df = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    schema = "host string, path string, verdict string"
    rules = [(None, "/", "block"), ("", "/", "block"), ("a.com", "/x", None), ("A.com", None, "block")]
    assert rows(apply_rules(df, spark.createDataFrame(rules, schema))) == [(1, "a.com", "/x", "a.com", "block")]
    assert rows(apply_rules(df, spark.createDataFrame([], schema), default="block")) == [(1, "a.com", "/x", None, "block")]


def test_block_wins_between_equal_rules(spark):
    df = spark.createDataFrame([(1, "http://a/x")], "page_id long, url string")
    rules = spark.createDataFrame([("a", "/x", v) for v in ("allow", "block", "allow")], "host string, path string, verdict string")
    assert rows(apply_rules(df, rules)) == [(1, "a", "/x", "a/x", "block")]


def test_tables(spark):
    rules = spark.createDataFrame([("a", "/", "block")], "host string, path string, verdict string")
    schema = "page_id long, url string, host int, rule string"
    assert apply_rules(spark.createDataFrame([], schema), rules).collect() == []
    df = spark.createDataFrame([(1, "http://a/", 3, "r"), (1, "http://a/", 3, "r"), (None, None, None, None)], schema)
    assert rows(apply_rules(df, rules)) == rows(
        spark.createDataFrame([(1, "a", "/", "a/", "block")] * 2 + [(None, "", "", None, "allow")], "a long, b string, c string, d string, e string")
    )
