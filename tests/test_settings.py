"""Results must not depend on session settings a cluster may differ in."""

import glob

import pytest
from conftest import SMALL
from support import rows

from loanscope.operators import reports as R
from loanscope.operators.cleaning import clean_loans
from loanscope.plans.queries import QUERIES
from loanscope.sources.writers import write_loans

SETTINGS = {
    "no_ansi": {"spark.sql.ansi.enabled": "false"},
    "no_adaptive": {"spark.sql.adaptive.enabled": "false"},
    "no_broadcast": {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    },
}
NAMES = ["clean_loans", "portfolio_summary"]


@pytest.fixture(scope="module")
def expected(spark):
    return {name: rows(QUERIES[name](spark, SMALL)) for name in NAMES}


@pytest.mark.parametrize("setting", SETTINGS)
@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, conf, expected, name, setting):
    for key, value in SETTINGS[setting].items():
        conf(key, value)
    assert rows(QUERIES[name](spark, SMALL)) == expected[name]


def test_a_hot_year_is_written_by_several_tasks(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    df = spark.range(200_000, numPartitions=8).selectExpr(
        "id", "uuid() AS text", "CAST(IF(id % 3 = 0, 2015, 1990 + id % 20) AS INT) AS year"
    )
    write_loans(df, str(tmp_path / "out"), partition_by_year=True)
    assert len(glob.glob(f"{tmp_path}/out/year=2015/part-*")) > 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200_000


def test_reports_after_a_hot_status(spark, golden_raw):
    """Two thirds of the rows share one id: the report still counts each id once."""
    many = golden_raw.where("id = '1'").crossJoin(spark.range(5000).select("id").withColumnRenamed("id", "copy"))
    clean = clean_loans(many.drop("copy").union(golden_raw).repartition(8))
    assert R.row_count(clean).first()[0] == 7
