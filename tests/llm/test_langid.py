"""Code lengths against a plain account of prediction by partial matching, and predictions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.support import DOCS, ODD_TEXTS, docs, held_out, random_text, small

from loanscope.llm import langid
from loanscope.llm.langid import ContextTrees, identify, train


def plain_bits(samples, text, order):
    """Bits of a text after counting all contexts of the samples: escape method C, shares among the unseen."""
    counts = defaultdict(Counter)
    for sample in samples:
        data = sample.lower().encode()
        for i, b in enumerate(data):
            for k in range(min(i, order) + 1):
                counts[data[i - k : i]][b] += 1

    def chances(context):
        own = counts.get(context)
        if not context and not own:
            return dict.fromkeys(range(256), 1 / 256)
        shorter = chances(context[1:]) if context else dict.fromkeys(range(256), 1 / 256)
        if not own:
            return shorter
        total, distinct = sum(own.values()), len(own)
        unseen = sum(p for b, p in shorter.items() if b not in own)
        return {
            b: own[b] / (total + distinct) if b in own else p * distinct / (total + distinct) / unseen
            for b, p in shorter.items()
        }

    data = text.lower().encode()
    return -sum(math.log2(chances(data[max(0, i - order) : i])[b]) for i, b in enumerate(data))


@pytest.mark.parametrize("order", [1, 2, 4])
def test_code_lengths(order):
    rng = random.Random(order)
    samples = {"x": [random_text(rng, 30) * 2] * 2, "y": [random_text(rng, 30).upper() * 2] * 2}
    trees = ContextTrees(samples, max_order=order, table_bytes=1 << 28)
    # Only bytes that training saw: those never seen share one place in the table.
    for text in ("", samples["x"][0][:50], samples["y"][0][5:60], "abc abc hgf"):
        got = trees.code_lengths([text])[0]
        assert got == pytest.approx([plain_bits(samples[n], text, order) for n in ("x", "y")], rel=1e-4, abs=1e-3)


def test_chances_after_a_context_add_up():
    trees = ContextTrees({"x": ["the cat sat on the mat " * 3], "y": ["le chat est assis " * 3]})
    seen = (2.0 ** -trees.bits[:, :-1].astype(float)).sum(axis=1)
    # The last symbol stands for all bytes never seen, each with that chance.
    never = (2.0 ** -trees.bits[:, -1].astype(float)) * (256 - trees.n_symbols + 1)
    assert seen + never == pytest.approx(np.ones_like(seen), rel=1e-4)


def test_batches_and_stretches_change_nothing(monkeypatch):
    rng = random.Random(0)
    trees = ContextTrees({"x": [random_text(rng, 200)], "y": [random_text(rng, 200)[::-1]]})
    texts = [random_text(rng, n) for n in (0, 1, 5, 300, 2, 50)] + ["", "é", "日本"]
    want = trees.code_lengths(texts)
    for size in (1, 10, 100):
        monkeypatch.setattr(langid, "BATCH_BYTES", size)
        assert trees.code_lengths(texts) == pytest.approx(want, rel=1e-5, abs=1e-3)
    assert np.array([trees.code_lengths([t])[0] for t in texts]) == pytest.approx(want, rel=1e-5, abs=1e-3)


def test_the_table_is_bounded():
    texts = {f"l{i}": [random_text(random.Random(i), 2000)] for i in range(6)}
    trees = ContextTrees(texts, table_bytes=200_000)
    assert trees.bits.nbytes <= 200_000 + trees.n_symbols * 4 * 6 * 2


def test_languages_take_no_room_from_each_other():
    texts = {f"l{i}": [random_text(random.Random(i), 2000)] * 2 for i in range(12)}
    few, many = (ContextTrees({name: texts[name] for name in sorted(texts)[:n]}) for n in (2, 12))
    assert set(many.left_out.values()) == {0}
    assert sum(few.children.astype(bool).sum(axis=1)) == many.roots[2] - 2
    for name in ("l0", "l1"):
        want = plain_bits(texts[name], texts["l3"][0][:300], 4)
        assert many.code_lengths([texts["l3"][0][:300]])[0][many.languages.index(name)] == pytest.approx(want, rel=1e-4)


def test_the_bound_is_a_parameter(spark):
    df = docs(spark, [random_text(random.Random(i), 2000) for i in range(40)], lang=["x", "y"] * 20)
    least, most = train(df, language_bytes=20_000), train(df)
    assert least.bits.nbytes <= 2 * 20_000 < most.bits.nbytes and min(least.left_out.values()) > 0
    assert set(most.left_out.values()) == {0}


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.createDataFrame([tuple(r.values()) for r in small("documents")], DOCS))


def test_real_words(spark, model):
    texts = {"en": "that the was with this", "de": "nicht auch die und der für", "fr": "le des les pour dans", "es": "el que para una del"}
    got = identify(docs(spark, list(texts.values())), model).collect()
    assert [r["lang_pred"] for r in got] == list(texts)
    assert all(0.5 < r["score"] <= 1 for r in got)


def test_odd_texts(spark, model):
    texts = [*ODD_TEXTS, "123 !?", "...\n", "١٢٣", "_", "ß"]
    df = docs(spark, texts, doc_id=[None, *range(1, len(texts))], lang=[None] * len(texts)).selectExpr("*", "1 AS score", "2 AS lang_pred")
    got = {r["doc_id"]: r for r in identify(df, model).collect()}
    for i, text in enumerate(texts):
        row = got[i or None]
        no_letter = not any(c.isalpha() for c in text or "")
        assert (row["lang_pred"] == "und") == no_letter and (row["score"] == 0) == no_letter
        assert 0 <= row["score"] <= 1 and row["held_out"] == held_out(i or None)


def test_training_uses_its_fold_only(spark, model):
    table = small("documents")
    turned = [(r["doc_id"], r["text"], "xx" if held_out(r["doc_id"]) else r["lang"], r["source"], r["n_chars"]) for r in table]
    other = train(spark.createDataFrame(turned, DOCS).repartition(5))
    assert other.languages == model.languages and np.array_equal(other.bits, model.bits)


def test_nothing_to_learn(spark):
    model = train(spark.createDataFrame([], DOCS))
    assert identify(spark.createDataFrame([], DOCS), model).collect() == []
    assert [tuple(r)[2:] for r in identify(docs(spark, ["abc", None]), model).collect()] == [("und", 0.0)] * 2
    one = train(docs(spark, ["abc def"] * 8, lang=["q"] * 8))
    assert [tuple(r)[2:] for r in identify(docs(spark, ["xyz"]), one).collect()] == [("q", 1.0)]


def test_the_sample_is_the_smallest_hashes_of_usable_texts(spark, monkeypatch):
    """However few rows are looked up at first; long texts cost the sample nothing."""
    from loanscope.llm import langid

    texts = [("z" * 99 if i % 3 == 0 else f"word {i} ") * 2 for i in range(900)]
    df = docs(spark, texts, lang=["big"] * 800 + ["small"] * 100)
    taken = {}
    monkeypatch.setattr(langid, "ContextTrees", lambda samples, **_: taken.update(samples))
    got = []
    for sampled, slack in ((4, 1000), (2, 0), (2, 5)):
        monkeypatch.setattr(langid, "SAMPLED", sampled)
        monkeypatch.setattr(langid, "SLACK", slack)
        train(df, per_language=20, max_bytes=100)
        got.append({k: sorted(v) for k, v in taken.items()})
    assert got[0] == got[1] == got[2] and {k: len(v) for k, v in got[0].items()} == {"big": 20, "small": 20}
    assert all(len(t) < 100 for v in got[0].values() for t in v)


def test_many_languages_are_learnt_within_the_bounds_or_not_at_all(spark):
    rng = random.Random(5)
    df = docs(spark, [random_text(rng, 30) for _ in range(900)], lang=[f"l{i % 300}" for i in range(900)])
    assert len(train(df).languages) > 250
    for bound in ({"max_languages": 200}, {"sample_bytes": 1000}, {"model_bytes": 100_000}):
        with pytest.raises(ValueError):
            train(df, **bound)
