"""Every query of the subpackage on the smallest tables, against SQL where there is any."""

import glob
import os
import random

import duckdb
import pytest
from llm.support import SMALL, held_out, rows, small

from loanscope.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    "op1_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op2_exact_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op3_sentencepiece": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op4_mixing": "doc_id bigint, source string, n_tokens bigint, weight double, block bigint, draw_key string",
    "op5_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, kept boolean",
    "op7_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op8_url_filters": "page_id bigint, host string, path string, rule string, verdict string",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint,"
    " offset bigint, ends_at string",
    "op12_collocation": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op13_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint, ends_sha256 string",
}

#: Their rows are not those of their table.
OTHER_ROWS = ("op2_exact_topk", "op4_mixing", "op11_packing", "op12_collocation", "op13_prefix_trie")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def result(spark):
    """Results by name, computed once."""
    done = {}

    def get(name):
        if name not in done:
            df = QUERIES[name](spark, SMALL)
            done[name] = (df.dtypes, rows(df))
        return done[name]

    return get


def test_every_operator_has_a_query():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(result, name):
    assert result(name)[0] == [tuple(c.split()) for c in COLUMNS[name].split(", ")]


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_same_as_sql(result, duck, name):
    found = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    types, got = result(name)
    assert sorted(columns) == sorted(c for c, _ in types)
    places = [[c for c, _ in types].index(c) for c in columns]
    assert sorted(([r[p] for p in places] for r in got), key=repr) == sorted(map(list, found.fetchall()), key=repr)


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in OTHER_ROWS])
def test_a_row_for_every_row(result, name):
    table = "pages" if "page_id" in COLUMNS[name] else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    assert sorted(r[0] for r in result(name)[1]) == sorted(r[key] for r in small(table))


def test_held_out_languages(result):
    langs = {r["doc_id"]: r["lang"] for r in small("documents")}
    predicted = [(i, held, lang) for i, held, lang, _ in result("op5_language_id")[1]]
    assert all(held == held_out(i) for i, held, _ in predicted)
    right = [lang == langs[i] for i, held, lang in predicted if held]
    assert sum(right) / len(right) > 0.9


def test_held_out_quality(result):
    labels = {r["doc_id"]: r["quality"] for r in small("labels")}
    scored = [(labels[i], score) for i, held, score, _ in result("op10_quality_classifier")[1] if held and i in labels]
    good, bad = ([s for q, s in scored if q == want] for want in (1, 0))
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert sum(pairs) / len(pairs) > 0.7  # about 30 bad texts to learn from


def test_results_do_not_depend_on_how_rows_are_dealt(spark, tmp_path):
    """The same rows in another order and number of files give the same results."""
    rng = random.Random(0)
    for name in ("documents", "labels"):
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        data = df.collect()
        rng.shuffle(data)
        spark.createDataFrame(data, df.schema).repartition(5).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("op4_mixing", "op5_language_id", "op6_quality_rules", "op7_sharding", "op9_simhash", "op10_quality_classifier"):
        assert rows(QUERIES[name](spark, str(tmp_path))) == rows(QUERIES[name](spark, SMALL)), name
