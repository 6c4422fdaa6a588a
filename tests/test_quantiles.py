import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from support import plan

from loanscope.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]


def expected(values, p):
    """Linear interpolation by hand over the sorted values."""
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    position = p * (len(ordered) - 1)
    below, above = ordered[math.floor(position)], ordered[math.ceil(position)]
    return below + (above - below) * (position - math.floor(position))


def check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = {r["probability"]: r["value"] for r in exact_quantiles(df, ["x"], PROBABILITIES).collect()}
    assert got == {p: expected(values, p) for p in PROBABILITIES}


def test_wide_range_and_neighbouring_doubles(spark):
    rng = np.random.default_rng(1)
    spread = rng.normal(0, 1, 400) * 10.0 ** rng.integers(-300, 300, 400)
    close = np.nextafter(1.0, 2) + np.arange(60) * 2.0**-52
    check(spark, [float(v) for v in np.concatenate([spread, close, [5e-324, -5e-324, 0.0, 1.7e308]])])


def test_hot_value(spark):
    check(spark, [7.0] * 500 + [float(v) for v in range(900)] + [7.000000000000001] * 3)


def test_negative_and_missing(spark):
    check(spark, [-3.5, None, -2.25, float("nan"), 0.0, 1.0, None, -3.5])


def test_one_value(spark):
    check(spark, [42.0])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_values(spark, values):
    check(spark, values)


def test_infinite_ends(spark):
    df = spark.createDataFrame([(v,) for v in [float("-inf"), 1.0, 2.0, 3.0, float("inf")]], "x double")
    got = {r["probability"]: r["value"] for r in exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    assert got == {0.25: 1.0, 0.5: 2.0, 0.75: 3.0}


def test_equal_infinite_neighbours(spark):
    inf = float("inf")
    for values, want in (([inf, inf, 1.0], inf), ([-inf, -inf, 1.0], -inf), ([inf, inf, inf, inf], inf)):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert exact_quantiles(df, ["x"], [0.5]).first()["value"] == want


def test_columns_do_not_mix_and_empty_ones_have_no_row(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, 20.0, None), (3, 60.0, None)], "a int, b double, c double")
    got = {r["column_name"]: r["value"] for r in exact_quantiles(df, ["a", "b", "c"], [0.5]).collect()}
    assert got == {"a": 2.0, "b": 20.0}


def test_no_value_buffer_in_one_task(spark):
    text = plan(exact_quantiles(spark.range(10).selectExpr("CAST(id AS DOUBLE) AS x"), ["x"], [0.5]))
    assert "percentile" not in text and "collect_list" not in text and "ObjectHashAggregate" not in text
