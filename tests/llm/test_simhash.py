"""SimHash fingerprints, links and components against plain accounts of the rules."""

import random

import numpy as np
import pytest
import xxhash
from llm.support import DOCS, ODD_TEXTS, WORD, docs, random_text, rows

from loanscope.llm import common, simhash
from loanscope.llm.simhash import close_pairs, components, deduplicate, hex_fingerprint, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, shingle=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, distance=3):
    """Smallest member of the class of each distinct fingerprint, by all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def families(rng, n, spread):
    """Fingerprints in families: copies with a few bits changed, again and again."""
    fps = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(3 * n):
        fp = rng.choice(fps)
        for _ in range(rng.randint(1, spread)):
            fp ^= 1 << rng.randrange(64)
        fps.append(fp)
    return sorted(set(fps))


def test_fingerprints_of_odd_texts(spark):
    texts = ODD_TEXTS + ["Ä b C", "a b", "A\x0bB", "one two three four", "É é"]
    got = near_duplicates(docs(spark, texts)).select("doc_id", hex_fingerprint().alias("f")).collect()
    assert {r["doc_id"]: r["f"] for r in got} == {i: f"{fingerprint(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("shingle", [1, 2, 3, 5])
def test_fingerprints_in_stretches(monkeypatch, shingle):
    rng = random.Random(shingle)
    for stretch in (1, 7, 50):
        monkeypatch.setattr(common, "STRETCH", stretch)
        for n in (0, 1, 2, 3, 4, 60):
            text = "  " + random_text(rng, n).replace(" ", " \n") + " "
            assert simhash.fingerprint(text.encode(), shingle) == fingerprint(text, shingle)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_pairs_connect_what_is_close(spark, distance):
    fps = families(random.Random(distance), 60, 3)
    found = close_pairs(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), distance).collect()
    assert all(0 < ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= distance for r in found)
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(found, "a long, b long")).collect()}
    got = {}
    for f in fps:
        got.setdefault(roots.get(signed(f), signed(f)), set()).add(f)
    want = {}
    for f, root in classes(fps, distance).items():
        want.setdefault(root, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("chunk_rows", [1, 3, 10])
def test_crowded_cells_lose_nothing(spark, chunk_rows):
    """Many fingerprints that agree in one half share a cell and are compared in parts."""
    rng = random.Random(9)
    fps = sorted({(0x12345678 << 32) | (f & 0xFFFF) for f in families(rng, 40, 2)})
    pairs = close_pairs(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), 3, chunk_rows)
    roots = {r["node"]: r["root"] for r in components(pairs).collect()}
    want = classes(fps)
    assert len(set(want.values())) == len({roots.get(signed(f), signed(f)) for f in fps})


def test_a_group_reports_few_links(spark):
    """All of a thousand fingerprints are close to one; pairs among them would be half a million."""
    rng = random.Random(1)
    fps = {0}
    while len(fps) < 1000:
        fps.add(sum(1 << b for b in rng.sample(range(20), rng.randint(1, 3))))
    found = close_pairs(spark.createDataFrame([(f,) for f in fps], "fp long")).count()
    assert found < 40_000


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(7000, 6000), (5000, 5000)]
    random.Random(0).shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1400)} | {7000: 6000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def near_copies(rng):
    base = random_text(rng, 400).split()
    texts = [" ".join(base)] * 3
    for _ in range(12):
        copy = list(base)
        copy[rng.randrange(len(copy))] = "changed"
        texts.append(" ".join(copy))
    return texts + [random_text(rng, 100) for _ in range(10)] + ["", None, "  "]


def test_component_ids(spark):
    texts = near_copies(random.Random(4))
    fps = [fingerprint(t) for t in texts]
    root = classes(fps)
    ids = [50 - i for i in range(len(texts))]
    smallest = {}
    for i, f in zip(ids, fps):
        smallest[root[f]] = min(i, smallest.get(root[f], i))
    got = near_duplicates(docs(spark, texts, doc_id=ids)).select("doc_id", "component_id")
    assert rows(got) == sorted(((i, smallest[root[f]]) for i, f in zip(ids, fps)), key=repr)
    assert len(smallest) < len(texts) - 5


def test_one_of_each_group_stays(spark):
    texts = near_copies(random.Random(4))
    df = docs(spark, texts, doc_id=range(10, 10 + len(texts)))
    kept = deduplicate(df)
    root, first = classes([fingerprint(t) for t in texts]), {}
    for i, t in enumerate(texts):
        first.setdefault(root[fingerprint(t)], i + 10)
    assert kept.schema == df.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())
    assert set(rows(kept)) <= set(rows(df))


def test_missing_and_repeated_ids(spark):
    texts = ["a b c d", "a b c d", "a b c d", "q r s t", "q r s t", "x y z", "x y z", ""]
    df = docs(spark, texts, doc_id=[None, 3, 3, None, None, 7, 7, None], source=[None, "b", "a", "a", "b", "s", "s", None])
    labelled = near_duplicates(df).select("doc_id", "component_id").collect()
    assert sorted(map(repr, ((r[0], r[1]) for r in labelled))) == sorted(
        map(repr, [(None, 3), (3, 3), (3, 3), (None, None), (None, None), (7, 7), (7, 7), (None, None)])
    )
    kept = deduplicate(df).collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept))) == sorted(
        map(repr, [(3, "a b c d"), (None, "q r s t"), (7, "x y z"), (None, "")])
    )
    assert {r["source"] for r in kept if r["doc_id"] == 3} <= {"a", "b"}


def test_extra_columns_and_empty_table(spark):
    df = docs(spark, ["a b c", "a b c"]).selectExpr("*", "1 AS fp", "2 AS root", "3 AS component_id", "4 AS a")
    assert rows(deduplicate(df)) == [(0, "a b c", "en", "s", 5, 1, 2, 3, 4)]
    empty = spark.createDataFrame([], DOCS)
    assert near_duplicates(empty).collect() == [] and deduplicate(empty).collect() == []


def test_bits_are_counted_without_a_carry(spark):
    fps = [0, -1, 2**63 - 1, -(2**63), 0x5555555555555555]
    cells = spark.createDataFrame([(f,) for f in fps], "fp long").select("fp", simhash._cells(3).alias("c")).collect()
    for row in cells:
        fp = row["fp"] & (2**64 - 1)
        counts = [(fp >> 2 * i & 3).bit_count() for i in range(32)]
        own = {c["block"]: c["cell"] for c in row["c"] if c["kind"] == 0}
        assert own == {b: sum(v << 2 * i for i, v in enumerate(counts[16 * b : 16 * b + 16])) for b in (0, 1)}
        assert np.all([sum(c["kind"] == 1 and c["block"] == b for c in row["c"]) == 1 + sum(v < 2 for v in counts[16 * b : 16 * b + 16]) for b in (0, 1)])


def test_columns_of_any_name_and_type(spark):
    """Names the operator itself uses, with other values in copies, a dotted name, a map and a nested one."""
    extra = ["7 + doc_id AS copy_", "8 AS row_hash_", "9 AS hash_", "1 AS id_", "2 AS copy", "3 AS row", "4 AS row_hash", "5 AS kept_id",
             "6 AS kept_hash", "10 AS `a.b`", "11 AS `c``d`", "map('k', doc_id) AS m", "array(struct(map(1, 2) AS i)) AS n"]
    df = docs(spark, ["a b c d", "a b c d", "x y z", "x y z"], doc_id=[4, 3, 9, 9]).selectExpr("*", *extra)
    kept = deduplicate(df)
    assert kept.schema == df.schema
    got = sorted(kept.collect(), key=lambda r: r["doc_id"])
    assert [(r["doc_id"], r["copy_"], r["id_"], r["a.b"], r["m"]) for r in got] == [(3, 10, 1, 10, {"k": 3}), (9, 16, 1, 10, {"k": 9})]
