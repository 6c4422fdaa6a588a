"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.support import DOCS, ODD_TEXTS, docs, rows, small

from loanscope.llm import piece_bpe
from loanscope.llm.piece_bpe import PieceBpe, token_digests, token_ids

with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
    MODEL = file.read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
BPE = PieceBpe(MODEL)


def ids_of(text):
    return np.concatenate(list(BPE.encode(text))).tolist()


def same(text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert ids_of(text) == ids
    assert BPE.decode(np.array(ids)) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aabcdeinorst  \n=-.", max_size=80))
def test_text_with_many_merges(text):
    same(text)


def test_pieces_side_by_side():
    rng = random.Random(1)
    pieces = list(BPE.ids)
    for _ in range(3000):
        same("".join(rng.choice(pieces) for _ in range(rng.randrange(8))))


def test_runs():
    for c in "aA=-0 \n▁😀":
        for n in range(1, 80):
            same(c * n)


def test_pairs_agree_with_plain_merging():
    rng = random.Random(2)
    pieces = list(BPE.parts)
    for _ in range(20_000):
        left, right = rng.choice(pieces), rng.choice(pieces)
        for pair in ([left, right], [left, left]):
            assert BPE._stay_apart(*pair) == (BPE.merge("".join(pair)) == pair)


def test_long_texts_in_stretches(monkeypatch):
    monkeypatch.setattr(piece_bpe, "STRETCH", 100)
    for text in ("ab cd  ef\n" * 200, "x" * 1000, " " * 500, "\n" * 500, "word " * 99 + "y" * 300):
        same(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 3)
    monkeypatch.setattr(piece_bpe, "REMEMBERED_PAIRS", 3)
    for row in small("documents")[:20]:
        same(row["text"])


def digests(text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    return (
        len(ids),
        hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
        hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
    )


def test_odd_texts_in_a_table(spark):
    df = docs(spark, ODD_TEXTS + [None, None], doc_id=[*range(len(ODD_TEXTS)), None, 0])
    want = [(i, *digests(t)) for i, t in zip([*range(len(ODD_TEXTS)), None, 0], ODD_TEXTS + [None, None])]
    assert rows(token_digests(df, MODEL)) == sorted(want, key=repr)


def test_extra_columns_and_empty_table(spark):
    df = docs(spark, ["a b"]).selectExpr("*", "1 AS n_tokens", "2 AS ids")
    assert rows(token_digests(df, MODEL)) == [(0, *digests("a b"))]
    assert rows(token_ids(df, MODEL)) == [(0, LIBRARY.encode("a b", add_bos=True, add_eos=True))]
    assert token_digests(spark.createDataFrame([], DOCS), MODEL).collect() == []


def test_other_models_are_refused():
    class Lowering:
        def normalize(self, text):
            return text.lower()

    with pytest.raises(ValueError):
        PieceBpe._check(Lowering())
