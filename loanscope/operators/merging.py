"""Reports from partial aggregates per year, which merge.

A state holds, of each year and column, the number of values, their mean, the sum
of squared deviations, least and most, and the co-moments with the default flag.
States of several years merge into the same numbers that one pass over all rows
gives, so a report over many years reads a few rows of each, and a year that
changes is computed anew alone.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.functions.statistics import direction, strength, without_nan
from loanscope.schema import STATISTIC_COLUMNS


def _moments(column: str) -> Column:
    x, y = without_nan(F.col(column)), F.col("is_default").cast("double")
    pair_x, pair_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.struct(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
        F.min(x).alias("min"), F.max(x).alias("max"),
        F.count(pair_x + pair_y).alias("pairs"), F.avg(pair_x).alias("mean_x"), F.avg(pair_y).alias("mean_y"),
        (F.var_pop(pair_x) * F.count(pair_x)).alias("m2_x"), (F.var_pop(pair_y) * F.count(pair_y)).alias("m2_y"),
        (F.covar_pop(x, y) * F.count(pair_x + pair_y)).alias("c_xy"),
    ).alias(column)


def moment_state(df: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS) -> DataFrame:
    """A row per year and column with its moments; the year may be missing. One aggregate over the rows."""
    wide = df.groupBy("year").agg(*[_moments(c) for c in columns])
    return wide.unpivot("year", list(columns), "column_name", "m").select("year", "column_name", "m.*")


def count_state(df: DataFrame, columns: Sequence[str] = ("is_default", "grade", "purpose")) -> DataFrame:
    """Rows per year and value of each column, as ``grouped_counts`` has them, with the year."""
    name = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in columns])
    return df.groupingSets([["year", c] for c in columns], "year", *columns).agg(name.alias("grouped_by"), F.count("*").alias("n"))


def merged_counts(state: DataFrame) -> DataFrame:
    """What ``grouped_counts`` gives for all years of the state, for the reports that take it."""
    columns = [c for c in state.columns if c not in ("grouped_by", "n", "year")]
    one = state.where(F.col("grouped_by") == columns[0])
    years = one.groupBy("year").agg(F.sum("n").alias("n")).withColumns(
        {"grouped_by": F.lit("year"), **{c: F.lit(None).cast(state.schema[c].dataType) for c in columns}}
    )
    rest = state.groupBy("grouped_by", *columns).agg(F.sum("n").alias("n")).withColumn("year", F.lit(None).cast(state.schema["year"].dataType))
    return rest.unionByName(years)


def merged_summary(state: DataFrame) -> DataFrame:
    """``portfolio_summary`` of all years of a state, but for the quartiles.

    Means merge by counts; squared deviations from them add up with the squared
    distances of the means, which cancels less than sums of squares do.
    """
    means = state.groupBy("column_name").agg(
        F.sum("n").alias("all"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("whole"),
        F.try_divide(F.sum(F.col("pairs") * F.col("mean_x")), F.sum("pairs")).alias("whole_x"),
        F.try_divide(F.sum(F.col("pairs") * F.col("mean_y")), F.sum("pairs")).alias("whole_y"),
    )
    # A row per column on the broadcast side.
    apart = state.join(F.broadcast(means), "column_name")
    dx, dy = F.col("mean_x") - F.col("whole_x"), F.col("mean_y") - F.col("whole_y")
    merged = apart.groupBy("column_name").agg(
        F.max("all").alias("n"), F.max("whole").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("whole"), 2)).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum(F.col("m2_x") + F.col("pairs") * dx * dx).alias("m2_x"),
        F.sum(F.col("m2_y") + F.col("pairs") * dy * dy).alias("m2_y"),
        F.sum(F.col("c_xy") + F.col("pairs") * dx * dy).alias("c_xy"),
    )
    spread = F.sqrt("m2_x") * F.sqrt("m2_y")
    corr = F.when(spread > 0, F.col("c_xy") / F.when(spread > 0, spread))
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / F.when(F.col("n") > 1, F.col("n") - 1)))
    return merged.select(
        "column_name", "n", F.round("mean", 4).alias("mean"), F.round(deviation, 4).alias("stddev"), "min", "max",
        F.round(corr, 6).alias("corr"), direction(corr).alias("direction"), strength(corr).alias("strength"),
    )
