"""The corpus pipeline: from raw documents to token counts and hashes, in five stages.

Each stage is a function of the session, the rows its predecessor kept and the
folder of the tables. All but the last return the columns of ``documents``.
"""

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanscope.llm import quality_classifier, quality_rules
from loanscope.llm.common import table
from loanscope.llm.mixing import repeat_to_weights
from loanscope.llm.piece_bpe import token_digests
from loanscope.llm.simhash import deduplicate
from loanscope.sources.scratch import intermediates, scratch_path

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    model = quality_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the trees go. The trees learn from the raw table, rejects included."""
    model = quality_rules.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.keep_passing(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return deduplicate(docs, shingle=3, max_distance=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their weights by repeating documents of the smaller ones; no document is lost."""
    return repeat_to_weights(docs, entropy=0.95, max_repeats=4.0)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids, given by their number and hash, and the hash of the decoded text."""
    return token_digests(docs, Path(PIECE_MODEL).read_bytes())


STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: Compression and tokenisation are beyond SQL; the tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What is written between and within them is removed at the end."""
    docs, result = table(spark, sf_dir, "documents"), scratch_path(spark, "corpus")
    with intermediates(spark) as folder:
        for name, stage in STAGES:
            path = result if name == STAGES[-1][0] else f"{folder}/{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
