"""Quantiles of any range of years from one small sketch per year and column."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.functions.statistics import without_nan
from loanscope.schema import STATISTIC_COLUMNS

#: A sketch keeps about three times as many values; ranks are off by less than ``RANK_ERROR`` of the rows, almost surely.
K = 400
RANK_ERROR = 0.01


def year_sketches(df: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS, k: int = K) -> DataFrame:
    """``year``, ``column_name``, ``n`` and ``sketch``: a KLL sketch of the values of a column in a year; NaN is missing.

    Sketches are built on the map side, so what is shuffled is bounded by years and columns.
    """
    sketches = [
        F.struct(F.count(v).alias("n"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")).alias(c)
        for c, v in ((c, without_nan(F.col(c))) for c in columns)
    ]
    wide = df.groupBy("year").agg(*sketches)
    return wide.unpivot("year", list(columns), "column_name", "s").select("year", "column_name", "s.*").where("n > 0")


def merged_quantiles(
    sketches: DataFrame, probabilities: Sequence[float], first_year: int | None = None, last_year: int | None = None
) -> DataFrame:
    """``column_name``, ``probability``, ``n`` and ``value`` over the years from first to last, all of them by default."""
    if first_year is not None:
        sketches = sketches.where(F.col("year") >= first_year)
    if last_year is not None:
        sketches = sketches.where(F.col("year") <= last_year)
    merged = sketches.groupBy("column_name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    pairs = F.inline(F.arrays_zip(asked.alias("probability"), F.kll_sketch_get_quantile_double("sketch", asked).alias("value")))
    return merged.select("column_name", "n", pairs).select("column_name", "probability", "n", "value")


def rank_errors(df: DataFrame, quantiles: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS) -> DataFrame:
    """``column_name``, ``probability`` and ``error``: how far the share of smaller rows is from the probability.

    Equal values have a range of ranks; the nearest counts. One pass over the rows.
    """
    rows = df.select(*[without_nan(F.col(c)).alias(c) for c in columns]).unpivot([], list(columns), "column_name", "v")
    # As many rows as columns times probabilities on the broadcast side.
    asked = F.broadcast(quantiles.select("column_name", "probability", "value"))
    below = rows.where("v IS NOT NULL").join(asked, "column_name").groupBy("column_name", "probability").agg(
        F.avg((F.col("v") < F.col("value")).cast("double")).alias("least"),
        F.avg((F.col("v") <= F.col("value")).cast("double")).alias("most"),
    )
    p = F.col("probability")
    return below.select("column_name", "probability", F.greatest(F.col("least") - p, p - F.col("most"), F.lit(0.0)).alias("error"))
