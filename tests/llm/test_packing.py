"""Packing: every id once, whole sequences, the cheapest cuts."""

import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from llm.support import DOCS, ODD_TEXTS, SMALL, docs, small
from tokenizers import Tokenizer

from loanscope.llm.packing import (
    DOCUMENT, END_ID, INSIDE, INSIDE_COST, SENTENCE, SENTENCE_COST, SEQUENCE_COST, Vocabulary, best_cuts, pack, places,
)
from loanscope.llm.queries import BYTE_MODEL, op11_packing

CONTENT = open(BYTE_MODEL, encoding="utf-8").read()


@cache
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def ids_of(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, END_ID]


def padding(length, width):
    return 0 if length & (length - 1) == 0 else width - length


def check(table, pieces, width):
    """Every id in exactly one piece, sequences without gaps; returns the lengths of the sequences."""
    assert all(r["length"] > 0 for r in pieces)
    want = {}
    for doc, text in table:
        want.setdefault(doc, []).append(ids_of(text))
    for doc, texts_ids in want.items():
        parts = sorted(((r["start"], r["ids"]) for r in pieces if r["doc_id"] == doc), key=lambda p: p[0])
        if len(texts_ids) == 1:
            assert b"".join(ids for _, ids in parts) == np.array(texts_ids[0], "<u4").tobytes()
        assert {r["doc_tokens"] for r in pieces if r["doc_id"] == doc} == set(map(len, texts_ids))
    assert sum(r["length"] for r in pieces) == sum(len(i) for found in want.values() for i in found)
    sequences = {}
    for r in pieces:
        assert len(r["ids"]) == 4 * r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    lengths = []
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= width
        lengths.append(place)
    return lengths


def test_query(spark):
    table = [(r["doc_id"], r["text"]) for r in small("documents")]
    pieces = op11_packing(spark, SMALL).collect()
    want = {i: ids_of(t) for i, t in table}
    for r in pieces:
        own = np.array(want[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(own) == r["length"] and r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(own.tobytes())
    assert sum(r["length"] for r in pieces) == sum(map(len, want.values()))
    lengths = {}
    for r in pieces:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    assert sum(padding(n, 2048) for n in lengths.values()) < 0.02 * sum(lengths.values())


def cheapest(at, kinds, width):
    """The cost of the best division, by trying every window."""
    charge = {DOCUMENT: 0, SENTENCE: SENTENCE_COST, INSIDE: INSIDE_COST}
    cost = [0]
    for j in range(1, len(at)):
        ways = [cost[i] + padding(at[j] - at[i], width) for i in range(j) if at[j] - at[i] <= width]
        cost.append(min(ways) + charge[kinds[j]] + SEQUENCE_COST)
    return cost[-1]


@pytest.mark.parametrize("width", [1, 5, 32, 100, 2048])
def test_cuts_are_the_cheapest(width):
    rng = random.Random(width)
    charge = {DOCUMENT: 0, SENTENCE: SENTENCE_COST, INSIDE: INSIDE_COST}
    for _ in range(8):
        lengths = [rng.choice([1, 3, 20, 150, 700]) for _ in range(rng.randint(1, 12))]
        documents = np.cumsum(lengths)
        sentences = np.array(sorted(rng.sample(range(1, int(documents[-1]) + 1), min(int(documents[-1]), rng.randint(0, 40)))), np.int64)
        at, kinds = places(sentences, documents, width)
        assert at[0] == 0 and at[-1] == documents[-1] and (np.diff(at) > 0).all() and np.diff(at).max() <= width or width < 128
        cuts, cost = best_cuts(at, kinds, width)
        ends = [0, *at[cuts].tolist()]
        assert ends[-1] == documents[-1] and max(np.diff(ends)) <= width
        paid = sum(padding(b - a, width) for a, b in zip(ends, ends[1:])) + sum(charge[kinds[c]] + SEQUENCE_COST for c in cuts)
        assert paid == cost == cheapest(at.tolist(), kinds.tolist(), width)


def test_sentences_end_where_they_should():
    vocabulary = Vocabulary(CONTENT)
    text = "It costs 3.14 today. Really?\nYes! (He said so.) End"
    ids = np.array(ids_of(text), np.uint32)
    before = [tokenizer().decode(ids[:e].tolist()) for e in vocabulary.sentence_ends(ids)]
    assert before == ["It costs 3.14 today.", "It costs 3.14 today. Really?\n", "It costs 3.14 today. Really?\nYes!", "It costs 3.14 today. Really?\nYes! (He said so.)"]


def test_documents_keep_their_order(spark):
    df = docs(spark, [f"word {i}. " * (i % 40) for i in range(300)]).coalesce(1)
    pieces = pack(df, CONTENT, width=64).orderBy("sequence_id", "offset").collect()
    assert [r["doc_id"] for r in pieces] == sorted(r["doc_id"] for r in pieces)
    lengths = check([(i, f"word {i}. " * (i % 40)) for i in range(300)], pieces, 64)
    assert {r["ends_at"] for r in pieces} <= {"document", "sentence", "inside"}
    assert sum(padding(n, 64) for n in lengths) < 0.1 * sum(lengths)


@pytest.mark.parametrize("block_tokens", [1, 700, 1 << 20])
def test_odd_texts_and_blocks(spark, block_tokens):
    names = {"start": "'x'", "length": "1", "sequence_id": "2L", "`a.b`": "map(1, 2)"}
    df = docs(spark, ODD_TEXTS).selectExpr("*", *(f"{v} AS {k}" for k, v in names.items()))
    pieces = pack(df, CONTENT, block_tokens=block_tokens).collect()
    check(list(enumerate(ODD_TEXTS)), pieces, 2048)


def test_one_long_word_is_cut_inside(spark):
    text = "".join(random.Random(1).choice("abcdefghij") for _ in range(30_000))
    pieces = pack(docs(spark, [text]), CONTENT).collect()
    lengths = check([(0, text)], pieces, 2048)
    assert len(lengths) > 3 and "inside" in {r["ends_at"] for r in pieces}
    assert sum(padding(n, 2048) for n in lengths) < 0.02 * sum(lengths)


def test_repeated_rows_missing_ids_and_no_rows(spark):
    df = docs(spark, ["a b", "a b", None, "a b"], doc_id=[1, 1, None, None])
    pieces = pack(df, CONTENT).collect()
    check([(1, "a b"), (1, "a b"), (None, None), (None, "a b")], pieces, 2048)
    assert pack(spark.createDataFrame([], DOCS), CONTENT).collect() == []
    with pytest.raises(ValueError):
        pack(df, CONTENT, width=0)


def test_special_names_are_ordinary_text(spark):
    pieces = pack(docs(spark, ["a<|endoftext|>b"]), CONTENT).collect()
    assert 50256 not in np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces])
