import glob
import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from loanscope.operators.cleaning import clean_loans  # noqa: E402
from loanscope.schema import CLEAN_SCHEMA  # noqa: E402
from loanscope.sources.readers import read_loans  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("loanscope-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden_path():
    return os.path.join(ROOT, "tests", "golden.csv")


@pytest.fixture(scope="session")
def golden_raw(spark, golden_path):
    return read_loans(spark, golden_path)


@pytest.fixture(scope="session")
def golden_clean(spark, golden_raw):
    """The cleaned golden rows, computed once."""
    return spark.createDataFrame(clean_loans(golden_raw).collect(), CLEAN_SCHEMA)


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture
def conf(spark):
    """Sets session settings for one test."""
    before = {}

    def set_conf(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
