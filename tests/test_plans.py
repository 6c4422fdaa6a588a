"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SMALL
from support import initial_plan, plan, rows

from loanscope.operators import reports as R
from loanscope.operators.cleaning import dedup_by_id
from loanscope.operators.joins import join_lookup
from loanscope.plans.queries import QUERIES
from loanscope.sources.readers import read_processed
from loanscope.sources.writers import write_loans

LAZY = [n for n in QUERIES if not n.startswith("scan") and "roundtrip" not in n and n not in (
    "phase_metrics", "phase_rows", "output_manifest", "output_listing", "input_manifest", "well_formed_rows"
)]


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_buffers(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set", "percentile("):
        assert bad not in text


def test_reports_read_only_their_columns(spark, golden_clean, tmp_path):
    path = str(tmp_path / "clean")
    write_loans(golden_clean, path)
    clean = read_processed(spark, path)
    used = {
        R.default_distribution: {"is_default"}, R.grade_top: {"grade"}, R.default_rate: {"is_default"},
        R.key_metrics: {"loan_amnt", "int_rate", "fico_avg"}, R.loan_amnt_stats: {"loan_amnt"},
        R.year_coverage: {"year"},
    }
    for report, columns in used.items():
        assert {frozenset(c) for c in read_columns(initial_plan(report(clean)))} == {frozenset(columns)}


def test_required_filter_reaches_the_scan(spark, golden_raw, tmp_path):
    from loanscope.operators.cleaning import required_filter, select_columns

    path = str(tmp_path / "raw")
    write_loans(golden_raw.transform(select_columns), path)
    text = initial_plan(required_filter(spark.read.parquet(path)))
    for column in ("loan_status", "annual_inc", "issue_d"):
        assert f"IsNotNull({column})" in text


def keyed_exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(id", initial_plan(df))


def test_dedup_shuffles_once_after_a_partial_reduction(spark):
    raw = spark.read.parquet(f"{SMALL}/orders.parquet").selectExpr(
        "CAST(o_orderkey AS STRING) AS id", "o_totalprice", "o_orderstatus"
    )
    for kept, partial in [
        (dedup_by_id(raw), "partial_min"),
        (dedup_by_id(raw, order_by=["o_totalprice"]), r"row_number\(\), 1, Partial"),
    ]:
        text = initial_plan(kept)
        assert len(keyed_exchanges(kept)) == 1
        # Printed top down, so the partial step stands below the exchange.
        assert re.search(r"Exchange hashpartitioning\(id.*" + partial, text, re.S)


def test_hot_id(spark):
    hot = spark.range(30_000, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS id", "CAST(id AS DOUBLE) AS v"
    )
    kept = dedup_by_id(hot)
    assert kept.count() == 20_001


@pytest.mark.parametrize("name", ["numeric_quartiles", "portfolio_summary", "loan_amnt_stats"])
def test_reports_of_several_passes_read_a_written_table(spark, name):
    """The dedup is done before; no pass repeats it."""
    text = plan(QUERIES[name](spark, SMALL))
    assert "SortAggregate" not in text.split("column_name")[-1] and "orders.parquet" not in text
    assert 1 <= text.count("FileScan parquet") <= 4


def test_correlation_takes_three_aggregates_a_column(spark, golden_clean):
    text = initial_plan(R.default_correlations(golden_clean, ["loan_amnt"]))
    partial = re.search(r"functions=\[(partial_[^\]]*)\]", text)[1]
    assert partial.count("partial_") == 3


def test_lookup_is_broadcast_only_below_the_threshold(spark, conf):
    small = QUERIES["broadcast_join"](spark, SMALL)
    assert "BroadcastHashJoin" in initial_plan(small)
    expected = rows(small)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    large = QUERIES["broadcast_join"](spark, SMALL)
    assert "SortMergeJoin" in initial_plan(large)
    assert rows(large) == expected


def test_join_with_a_hot_key(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    right = spark.range(3000).selectExpr("id AS k", "id * 2 AS w")
    assert join_lookup(left, right, "k").count() == 3000


def test_year_sink_rebalances(spark, golden_clean):
    text = golden_clean.hint("rebalance", "year")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in text
