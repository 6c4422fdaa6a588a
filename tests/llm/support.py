"""Small tables and plain accounts of the rules, shared by the tests of this folder."""

import random
import re
import zlib

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def small(name):
    return pq.read_table(f"{SMALL}/{name}.parquet").to_pylist()


def docs(spark, texts, **columns):
    """A documents table of the texts, ids from 0; columns gives other values by name."""
    ids = columns.get("doc_id", range(len(texts)))
    langs, sources = columns.get("lang", ["en"] * len(texts)), columns.get("source", ["s"] * len(texts))
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in zip(ids, texts, langs, sources)], DOCS
    )


#: Texts that break careless code.
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "a b", "a b c", "A B C", "a  b\tc", "x" * 5000, "the cat sat on the mat " * 9000,
    "é" * 300, "日本語 テキスト", "\x00\x1c\x85\xa0", "a|b #c $d", "▁a ▁▁", "😀 😀 😀 😀", "dup\ndup\ndup", "a b c",
]


def random_text(rng: random.Random, n_words: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n_words))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def training_rows(n=240, seed=3):
    """Texts and labels: good ones are plain, bad ones carry symbols after their words or repeat themselves."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text, good = random_text(rng, 120), i % 2
        if not good:
            text = re.sub(r"\b ", " ## ", text) if i % 4 else f"{text[:20]} " * 60
        out.append((i, text, good))
    return out
