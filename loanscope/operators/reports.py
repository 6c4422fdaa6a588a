"""Portfolio reports over the cleaned loan table; each returns a small table.

Nothing here collects rows. Every report aggregates on the map side first, so
its shuffle is bounded by the number of groups.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanscope.functions.statistics import direction, percent, safe_corr, strength, without_nan
from loanscope.operators.quantiles import exact_quantiles
from loanscope.schema import KEY, PREVIEW_COLUMNS, STATISTIC_COLUMNS
from loanscope.sources.scratch import checkpointed


def row_count(df: DataFrame) -> DataFrame:
    if "grouped_by" in df.columns:
        return _counts(df, "is_default").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return df.agg(F.count("*").alias("n"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` loans by id."""
    return df.select(KEY, *PREVIEW_COLUMNS).orderBy(KEY).limit(n)


# --- Distributions ---


GROUPED_COLUMNS = ["is_default", "year", "grade", "purpose"]


def grouped_counts(df: DataFrame, columns: Sequence[str] = GROUPED_COLUMNS) -> DataFrame:
    """Rows per value of each column, from one aggregate: ``grouped_by``, the columns, ``n``.

    The distributions and shares of this module take such a table in place of the loans.
    """
    name = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in columns])
    return df.groupingSets([[c] for c in columns], *columns).agg(name.alias("grouped_by"), F.count("*").alias("n"))


def _counts(df: DataFrame, key: str) -> DataFrame:
    if "grouped_by" in df.columns:
        return df.where(F.col("grouped_by") == key).select(key, "n")
    return df.groupBy(key).agg(F.count("*").alias("n"))


def _with_share(counts: DataFrame) -> DataFrame:
    """Adds each group's percentage of all rows.

    The total is a one-row subquery, so the groups are never gathered.
    """
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total))


def _top(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; the share counts rows without a value too."""
    shares = _with_share(_counts(df, key))
    return shares.where(F.col(key).isNotNull()).orderBy(F.desc("n"), key).limit(n)


def default_distribution(df: DataFrame) -> DataFrame:
    return _with_share(_counts(df, "is_default")).orderBy("is_default")


def year_distribution(df: DataFrame) -> DataFrame:
    return _counts(df, "year").orderBy("year")


def grade_distribution(df: DataFrame) -> DataFrame:
    return _counts(df, "grade").orderBy("grade")


def grade_top(df: DataFrame, n: int = 10) -> DataFrame:
    return _top(df, "grade", n).orderBy("grade")


def purpose_top(df: DataFrame, n: int = 10) -> DataFrame:
    # The window sees the n rows left by the limit.
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "purpose"))
    return _top(df, "purpose", n).select(rank.alias("rank"), "purpose", "n", "pct").orderBy("rank")


def distinct_years(df: DataFrame) -> DataFrame:
    return df.select("year").distinct()


def year_coverage(df: DataFrame) -> DataFrame:
    return _counts(df, "year").agg(
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.count_distinct("year").alias("n_years"),
    )


# --- Numeric summaries ---


def _describe(value: Column) -> list[Column]:
    return [
        F.count(value).alias("n"),
        F.round(F.avg(value), 4).alias("mean"),
        F.round(F.stddev_samp(value), 4).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def _wide(columns: Sequence[str], measures) -> list[Column]:
    """``measures(column)`` of each column, a struct per column."""
    return [F.struct(*measures(c)).alias(c) for c in columns]


def _long(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    return wide.unpivot([], list(columns), "column_name", "measures").select("column_name", "measures.*")


def _per_column(df: DataFrame, columns: Sequence[str], measures) -> DataFrame:
    """``measures(column)`` of each column, one row per column.

    One aggregate over the unexpanded rows; only its single result row is
    turned from wide to long.
    """
    return _long(df.agg(*_wide(columns, measures)), columns)


def numeric_describe(df: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS) -> DataFrame:
    """Count, mean, sample deviation and range; NaN counts as a value."""
    return _per_column(df, columns, lambda c: _describe(F.col(c).cast("double")))


def _key_metrics() -> list[Column]:
    return [
        F.min("loan_amnt").alias("min_loan"),
        F.max("loan_amnt").alias("max_loan"),
        F.round(F.avg("loan_amnt"), 4).alias("avg_loan"),
        F.round(F.avg("int_rate"), 4).alias("avg_int_rate"),
        F.round(F.avg("fico_avg"), 4).alias("avg_fico"),
    ]


def key_metrics(df: DataFrame) -> DataFrame:
    return df.agg(*_key_metrics())


def _quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    return (
        exact_quantiles(df, columns, list(names))
        .groupBy("column_name")
        .agg(*[F.round(F.max(F.when(F.col("probability") == p, F.col("value"))), 4).alias(q) for p, q in names.items()])
    )


def numeric_quartiles(df: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS) -> DataFrame:
    """Exact interpolated quartiles; a column without values has no row."""
    return _quartiles(df, columns)


def approx_quartiles(
    df: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS, accuracy: int = 10_000
) -> DataFrame:
    """Quartiles from one pass, each within 1/``accuracy`` of the rows of its true rank."""
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    sketches = _per_column(
        df,
        columns,
        lambda c: [F.approx_percentile(without_nan(F.col(c)), quarters, F.lit(accuracy)).alias("q")],
    )
    return sketches.select("column_name", *[F.col("q")[i].alias(f"q{25 * (i + 1)}") for i in range(3)])


def _value_stats(df: DataFrame, column: str) -> DataFrame:
    """Range, mean, deviation and exact median of one column; NaN is missing."""
    stats = _per_column(df, [column], lambda c: _describe(without_nan(F.col(c))))
    median = exact_quantiles(df, [column], [0.5]).select("column_name", F.round("value", 4).alias("median"))
    # One row at most on the broadcast side.
    return stats.join(F.broadcast(median), "column_name", "left")


def loan_amnt_stats(df: DataFrame) -> DataFrame:
    return _value_stats(df, "loan_amnt").select("min", "max", "mean", "median", "stddev")


def int_rate_stats(df: DataFrame) -> DataFrame:
    return _value_stats(df, "int_rate").select("min", "max", "mean", "median")


def fico_stats(df: DataFrame) -> DataFrame:
    return _value_stats(df, "fico_avg").select("min", "max", "mean", "median")


# --- Default risk ---


def _correlation(column: str) -> Column:
    return safe_corr(without_nan(F.col(column)), F.col("is_default").cast("double"))


def _with_labels(df: DataFrame) -> DataFrame:
    corr = F.col("corr")
    return df.withColumns({"direction": direction(corr), "strength": strength(corr)}).withColumn("corr", F.round(corr, 6))


def default_correlations(df: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS) -> DataFrame:
    """Pearson correlation of each column with the default flag, with labels."""
    return _with_labels(_per_column(df, columns, lambda c: [_correlation(c).alias("corr")]))


def default_rate(df: DataFrame) -> DataFrame:
    """Percent of loans in default; 0 for an empty table."""
    counts = _counts(df, "is_default").where("is_default IS NOT NULL")
    rate = F.round(F.try_divide(F.sum(F.col("is_default") * F.col("n")), F.sum("n")) * 100, 2)
    return counts.agg(F.coalesce(rate, F.lit(0.0)).alias("default_rate_pct"))


def _portfolio_measures(column: str) -> list[Column]:
    return [*_describe(without_nan(F.col(column))), _correlation(column).alias("corr")]


def _portfolio(measures: DataFrame, quartiles: DataFrame) -> DataFrame:
    # One row per column on the broadcast side.
    return _with_labels(measures.join(F.broadcast(quartiles), "column_name", "left"))


def portfolio_summary(df: DataFrame, columns: Sequence[str] = STATISTIC_COLUMNS) -> DataFrame:
    """Describe, quartiles and default correlation of each column in one table.

    All plain measures share one aggregate, so the table is read once for them
    and three times for the quartiles, however many columns are asked for.
    """
    return _portfolio(_per_column(df, columns, _portfolio_measures), _quartiles(df, columns))


def all_reports(df: DataFrame) -> dict[str, DataFrame]:
    """Every report of a written table, from one count of groups, one aggregate and one set of quartiles.

    These three small tables are written to the shared folder at once; what the
    reports do with them costs next to nothing.
    """
    groups = checkpointed(grouped_counts(df))
    metrics = F.struct(*_key_metrics()).alias("key_metrics")
    wide = checkpointed(df.agg(*_wide(STATISTIC_COLUMNS, _portfolio_measures), metrics))
    quartiles = checkpointed(_quartiles(df, STATISTIC_COLUMNS))
    return {
        "row_count": row_count(groups),
        "preview": preview(df),
        "default_distribution": default_distribution(groups),
        "year_distribution": year_distribution(groups),
        "grade_distribution": grade_distribution(groups),
        "grade_top10": grade_top(groups),
        "purpose_top10": purpose_top(groups),
        "key_metrics": wide.select("key_metrics.*"),
        "year_coverage": year_coverage(groups),
        "default_rate": default_rate(groups),
        "portfolio_summary": _portfolio(_long(wide.drop("key_metrics"), STATISTIC_COLUMNS), quartiles),
    }


def run_summary(df: DataFrame, source: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(source).alias("source")
    )
