"""One query per operator over its whole table, and the same in SQL where SQL can express it."""

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm import langid, quality_classifier, quality_rules
from loanscope.llm.collocation import collocations
from loanscope.llm.common import table
from loanscope.llm.html_extract import main_text
from loanscope.llm.mixing import mix
from loanscope.llm.packing import pack
from loanscope.llm.piece_bpe import token_digests
from loanscope.llm.prefix_trie import prefix_trie
from loanscope.llm.sharding import assign_shards
from loanscope.llm.simhash import hex_fingerprint, near_duplicates
from loanscope.llm.topk import top_k
from loanscope.llm.url_rules import apply_rules

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 40
#: Fixed values of the url query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=10)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), Path(PIECE_MODEL).read_bytes())


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), entropy=0.95, max_repeats=4.0, budget=1.0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return apply_rules(table(spark, sf_dir, "pages"), rules)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = near_duplicates(table(spark, sf_dir, "documents"))
    return labelled.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), Path(BYTE_MODEL).read_text())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ends_at"
    )


def op12_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_exact_topk": op2_exact_topk,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_sharding": op7_sharding,
    "op8_url_filters": op8_url_filters,
    "op9_simhash": op9_simhash,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_packing": op11_packing,
    "op12_collocation": op12_collocation,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL = {
    "op2_exact_topk": """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE embedding IS NOT NULL
), whole AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))
), ints AS (
  SELECT vec_id, i, floor(1024 * x)::BIGINT AS x FROM parts JOIN whole USING (vec_id)
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM ints q JOIN ints c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scores
) WHERE rank <= 10
""",
    # Bisects the exponent, in millionths: ``e`` for the entropy, ``r`` for the repeats.
    "op4_mixing": """
WITH RECURSIVE counted AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS stratum,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents
), totals AS (
  SELECT stratum, sum(n_tokens)::BIGINT AS tokens FROM counted GROUP BY 1
), whole AS (
  SELECT sum(tokens)::BIGINT AS total, count(*) FILTER (WHERE tokens > 0) AS n FROM totals
), shares AS (
  SELECT stratum, tokens, tokens / total::DOUBLE AS share FROM totals, whole
), e(lo, hi) AS (
  SELECT -1, 1000000
  UNION ALL
  SELECT CASE WHEN holds THEN lo ELSE mid END, CASE WHEN holds THEN mid ELSE hi END FROM (
    SELECT lo, hi, mid, ln(z) - mid / 1e6 * g / z < 0.95 * ln(n) AS holds FROM (
      SELECT any_value(lo) AS lo, any_value(hi) AS hi, mid, sum(pow(share, mid / 1e6)) AS z, sum(pow(share, mid / 1e6) * ln(share)) AS g
      FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM e WHERE hi - lo > 1) AS m, shares WHERE share > 0 GROUP BY mid
    ) AS sums, whole
  ) AS decided
), r(lo, hi) AS (
  SELECT -1, 1000000
  UNION ALL
  SELECT CASE WHEN holds THEN lo ELSE mid END, CASE WHEN holds THEN mid ELSE hi END FROM (
    SELECT any_value(lo) AS lo, any_value(hi) AS hi, mid, max(pow(share, mid / 1e6 - 1)) / sum(pow(share, mid / 1e6)) <= 4 AS holds
    FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM r WHERE hi - lo > 1) AS m, shares WHERE share > 0 GROUP BY mid
  ) AS decided
), ends AS (
  SELECT (SELECT min(hi) FROM e) AS e, (SELECT min(hi) FROM r) AS r
), exponent AS (
  SELECT greatest(CASE WHEN e < 1000000 THEN greatest(e - 1, 0) ELSE e END, r) / 1e6 AS a FROM ends
), powers AS (
  SELECT stratum, tokens, CASE WHEN share > 0 THEN pow(share, a) ELSE 0 END AS p FROM shares, exponent
), weights AS (
  SELECT stratum, tokens, round(p / (SELECT sum(p) FROM powers), 9) AS weight FROM powers
), quotas AS (
  SELECT stratum, weight,
    CASE WHEN tokens > 0 THEN floor(weight * total)::BIGINT // tokens ELSE 1 END AS whole_blocks,
    CASE WHEN tokens > 0 THEN floor(weight * total)::BIGINT % tokens ELSE 0 END AS left_over
  FROM weights, whole
), keyed AS (
  SELECT c.*, weight, whole_blocks, left_over, md5(concat_ws('|', '0', whole_blocks, doc_id)) AS last_key
  FROM counted c JOIN quotas USING (stratum)
), summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY stratum ORDER BY last_key) AS so_far FROM keyed
), numbered AS (
  SELECT *, whole_blocks + (left_over > 0 AND so_far <= left_over)::INT AS n_blocks FROM summed
), drawn AS (
  SELECT *, unnest(range(n_blocks)) AS block FROM numbered
)
SELECT doc_id, source, n_tokens, weight, block, md5(concat_ws('|', '0', block, doc_id)) AS draw_key FROM drawn
""",
    "op8_url_filters": """
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), fitting AS (
  SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS place
  FROM parts p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fitting WHERE place = 1
""",
    "op12_collocation": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM starts, (SELECT unnest(range(1, 5)) AS k) WHERE i + k - 1 <= len(w)
), totals AS (
  SELECT lang, count(*) AS n FROM starts GROUP BY 1
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), inner_phrases AS (
  SELECT lang, a, array_to_string(w[i:i + len - 1], ' ') AS phrase
  FROM candidates, (SELECT unnest(range(2, 4)) AS len), (SELECT unnest(range(1, 4)) AS i) WHERE len < k AND i + len - 1 <= k
), longer AS (
  SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY 1, 2
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r, 2000000 * c.a::HUGEINT // (x.a + y.a)::HUGEINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM weakest JOIN totals USING (lang) QUALIFY rank <= 2000
""",
    # The unsigned CRC-32 of the decimal id, bit by bit: x is the register, 3988292384 its polynomial.
    "op13_prefix_trie": """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
  SELECT conv_id, xor(list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
    lambda x, b: list_reduce(range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)), xor(x, b)),
    4294967295::BIGINT), 4294967295) % 9 AS h
  FROM turns WHERE place = 1
), rebuilt AS (
  SELECT a.conv_id, 0 AS part, b.place, b.role, b.text FROM hashed a JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 5 AND b.place <= h
  UNION ALL
  SELECT conv_id, 1, place, role, text FROM turns JOIN hashed USING (conv_id) WHERE place > h
), listed AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, place) AS path FROM rebuilt GROUP BY 1
), paths AS (
  SELECT conv_id, coalesce(path, []) AS path FROM hashed LEFT JOIN listed USING (conv_id)
), members AS (
  SELECT conv_id, path[1:d] AS prefix, d, d = len(path) AS ends FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY 1, 2
), kids AS (
  SELECT prefix[1:d - 1] AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), own AS (
  SELECT prefix, d, n_children IS NULL AS leaf, CASE WHEN d > 0 THEN (n_convs - 1) * strlen(prefix[d].text) ELSE 0 END AS saved
  FROM nodes LEFT JOIN kids USING (prefix)
), sums AS (
  SELECT prefix[1:up] AS prefix, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM own) GROUP BY 1
)
SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, a.ends_sha256
FROM nodes a LEFT JOIN nodes b ON a.d > 0 AND b.d = a.d - 1 AND b.prefix = a.prefix[1:a.d - 1]
LEFT JOIN kids ON kids.prefix = a.prefix JOIN sums ON sums.prefix = a.prefix
""",
}
