"""Phrases and their scores, against plain counting."""

import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from llm.support import DOCS, ODD_TEXTS, docs, rows

from loanscope.llm import collocation
from loanscope.llm.collocation import collocations, phrase_counts
from loanscope.sources.scratch import work_folder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(table):
    """Occurrences by language and phrase, a tuple of words, of up to four words."""
    found = defaultdict(Counter)
    for lang, text in table:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    found["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    return found


def plain(table, threshold, per_lang):
    out = []
    for lang, f in counts(table).items():
        total = sum(n for p, n in f.items() if len(p) == 1)
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= threshold}
        dropped = set()
        for p, n in candidates.items():
            for k in range(2, len(p)):
                dropped |= {q for i in range(len(p) - k + 1) if 100 * n >= 80 * f[q := p[i : i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:per_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out, key=repr)


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "The", "日本", "a-b"]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for _ in range(n):
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in rng.choices(words, weights, k=rng.randint(0, 40)))
        out.append((rng.choice(["en", "en", "fr", None]), text + rng.choice(["", "new york city is big"])))
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(collocation, "BLOCK_WORDS", 64)


def table(spark, texts):
    return docs(spark, [t for _, t in texts], lang=[lang for lang, _ in texts])


@pytest.mark.parametrize("shards, bits", [(1, 24), (3, 24), (4, 24), (3, 1), (4, 5)])
def test_same_as_plain_counting(spark, small_blocks, shards, bits):
    """Whatever the shards, and with buckets so few that most phrases share theirs."""
    texts = corpus()
    got = rows(collocations(table(spark, texts).repartition(3), threshold=8, per_lang=60, shards=shards, bucket_bits=bits))
    assert got == plain(texts, 8, 60)


def test_every_frequent_phrase_is_counted_whole(spark, small_blocks):
    texts = corpus(200, 2)
    with work_folder(spark) as folder:
        found = phrase_counts(table(spark, texts), folder, threshold=5, shards=3).collect()
    want = counts(texts)
    got = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in found if r["phrase"] is not None}
    assert got == {(lang, p): n for lang, f in want.items() for p, n in f.items() if n >= 5}
    totals = {r["lang"]: r["n"] for r in found if r["phrase"] is None}
    assert totals == {lang: sum(n for p, n in f.items() if len(p) == 1) for lang, f in want.items()}


def test_a_phrase_that_is_frequent_only_in_all_shards_together(spark):
    """No shard alone has the threshold, nor do its words reach it early."""
    texts = [("en", f"x{i} red green blue sky y{i}") for i in range(30)]
    assert rows(collocations(table(spark, texts), shards=4)) == plain(texts, 30, 2000)


def test_pieces_repeats_and_ties(spark):
    texts = [("en", "a a a a a. a a\nb b, b b; c d: c d! c d? C D")] * 40 + [("de", "a b c d")] * 30 + [("de", "a b. b c. c d")] * 5
    assert rows(collocations(table(spark, texts), per_lang=3)) == plain(texts, 30, 3)


def test_one_text_in_most_rows(spark):
    texts = [("en", "the same words again and again")] * 300 + corpus(50, 3)
    df = table(spark, texts).withColumn("doc_id", spark.range(1).selectExpr("CAST(NULL AS BIGINT)").scalar())
    assert rows(collocations(df)) == plain(texts, 30, 2000)


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(collocation, "STRETCH", 100)
    texts = [("en", t) for t in ODD_TEXTS] + [(None, "x y z " * 40), ("", "x y z " * 40), ("en", "no end here " * 500)]
    df = table(spark, texts).selectExpr("*", "1 AS shard", "'x' AS phrase", "2 AS n", "map(1, 2) AS `a.b`")
    assert rows(collocations(df, threshold=3)) == plain(texts, 3, 2000)


@pytest.mark.parametrize("room", [50, 1 << 52, 1 << 53, 1 << 62])
def test_keys_are_grouped_whether_or_not_their_places_fit_beside_them(room):
    key = np.random.default_rng(1).integers(0, 40, 1000) + (room - 50)
    order, new = collocation._grouped(key, room)
    assert order.tolist() == np.argsort(key, kind="stable").tolist()
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    assert order[new].tolist() == first.tolist() and np.diff(new, append=len(key)).tolist() == n.tolist()


@pytest.mark.parametrize("size", [5, 1 << 14, 1 << 18, 1 << 30])
def test_distinct_phrases_of_a_block(size):
    """Small and large vocabularies, whose phrases are numbered anew after some or every word."""
    codes = np.random.default_rng(2).integers(1, 5, 2000) * (size // 5)
    for length in range(1, 5):
        at = np.arange(len(codes) - length + 1)
        places, n = collocation._distinct(codes, at, length, size)
        phrases = [tuple(codes[i : i + length].tolist()) for i in at]
        assert dict(zip([phrases[i] for i in places], n.tolist())) == Counter(phrases) and len(places) == len(set(phrases))


def block_of(n_words):
    """Words of a Zipf law as one block."""
    numbers = np.random.default_rng(1).zipf(1.3, n_words) % 5000
    columns = [pa.array([0], pa.int32()), pa.array(["en"]), pa.array([" ".join(f"w{i}" for i in numbers.tolist())])]
    (block,) = collocation._Blocks(2 * n_words)(iter([pa.RecordBatch.from_arrays(columns, names=["shard", "lang", "text"])]))
    return numbers, block


def test_a_block_is_small_where_spark_holds_it():
    numbers, block = block_of(1 << 16)
    assert block.nbytes < 3 * len(numbers)
    lang, words, codes = collocation._content(block, 0)
    assert lang == "en" and [words[i] for i in np.frombuffer(codes, "<i4")[1:-1]] == [b"w%d" % i for i in numbers]
    nothing = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array(["en"]), pa.array(["."])], names=["shard", "lang", "text"])
    (block,) = collocation._Blocks(9)(iter([nothing]))
    assert collocation._content(block, 0)[1] == [b"\n"]


@pytest.mark.parametrize("scan, most", [("_Scan", 125), ("_Names", 200)])
def test_a_task_over_a_block_full_of_frequent_phrases_holds_little(monkeypatch, scan, most):
    """Bytes a word at once, rows handed over at once, and what the worker does with the memory in the end."""
    numbers, block = block_of(1 << 18)
    given_back = []
    monkeypatch.setattr(collocation, "_give_back", lambda: given_back.append(1), raising=False)
    ones = SimpleNamespace(value=zlib.compress(np.ones(1 << 16, np.uint8).tobytes(), 1))
    table = SimpleNamespace(value=zlib.compress(np.zeros(1 << 16, np.uint8).tobytes(), 1))
    task = collocation._Scan(table, 1, 2) if scan == "_Scan" else collocation._Names(table, ones, 2)
    tracemalloc.start()
    try:
        rows = [batch.num_rows for batch in task(iter([block]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    words = [*numbers.tolist()]
    assert sum(rows) == sum(len({tuple(words[i : i + k]) for i in range(len(words) - k + 1)}) for k in range(1, 5))
    assert peak < most * len(numbers) and max(rows) <= 1 << 16 and given_back == [1]


def test_no_rows_and_wrong_parameters(spark):
    nothing = spark.createDataFrame([], DOCS)
    assert collocations(nothing).collect() == []
    assert collocations(docs(spark, ["a b", None])).collect() == []
    with work_folder(spark) as folder, pytest.raises(ValueError):
        phrase_counts(nothing, folder, shards=0)
