"""Aggregate expressions shared by the reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanscope.schema import MODERATE_CORRELATION, STRONG_CORRELATION


def without_nan(value: Column) -> Column:
    """The value as a double, NaN counted as missing."""
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows that have both values.

    NULL where either side is constant. ``F.corr`` raises a division by zero
    there under ANSI mode, and a CASE around it does not help because the
    aggregate is evaluated first.
    """
    x_pair = F.when(y.isNotNull(), x)
    y_pair = F.when(x.isNotNull(), y)
    spread = F.sqrt(F.var_pop(x_pair)) * F.sqrt(F.var_pop(y_pair))
    return F.when(spread > 0, F.covar_pop(x, y) / F.when(spread > 0, spread))


def direction(corr: Column) -> Column:
    return F.when(corr > 0, "positive").when(corr.isNotNull(), "negative")


def strength(corr: Column) -> Column:
    size = F.abs(corr)
    return (
        F.when(size > STRONG_CORRELATION, "strong")
        .when(size > MODERATE_CORRELATION, "moderate")
        .when(size.isNotNull(), "weak")
    )


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` to 2 decimals; NULL if ``whole`` is 0."""
    return F.round(F.try_divide(part * 100, whole), 2)
