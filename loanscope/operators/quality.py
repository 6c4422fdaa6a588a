"""Row loss, completeness and validation, each from one pass over the table."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.functions import parsing as P
from loanscope.functions.statistics import percent
from loanscope.operators.cleaning import select_columns
from loanscope.schema import KEY, NUMERIC_COLUMNS, REQUIRED_COLUMNS, SELECTED_COLUMNS
from loanscope.sources.records import TOO_LONG, TOO_SHORT, UNCLOSED


def is_complete() -> Column:
    """True for a row that has all required fields."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in REQUIRED_COLUMNS])


def row_loss(raw: DataFrame) -> DataFrame:
    """Rows before and after each cleaning step.

    One scan of four columns and one shuffle of ids. The counts come from the
    data, not from an ``Observation``: observed counts grow when the
    tasks of a lost executor run again.
    """
    complete = is_complete()
    # All rows the filter drops share one group, every other id has its own.
    counts = (
        raw.transform(select_columns)
        .groupBy(complete.alias("complete"), F.when(complete, F.col(KEY)).alias(KEY))
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_raw"),
            F.coalesce(F.sum(F.when(F.col("complete"), F.col("n"))), F.lit(0)).alias("n_filtered"),
            F.count(F.when(F.col("complete"), 1)).alias("n_unique"),
        )
    )
    return loss_table(counts)


def loss_table(counts: DataFrame) -> DataFrame:
    """One row per step from a row of ``n_raw``, ``n_filtered`` and ``n_unique``."""
    steps = counts.selectExpr(
        """stack(3, 'required_filter', n_raw, n_filtered,
                    'dedup_by_id', n_filtered, n_unique,
                    'total', n_raw, n_unique) AS (step, rows_before, rows_after)"""
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return steps.select(
        "step",
        "rows_before",
        "rows_after",
        removed.alias("removed"),
        F.coalesce(percent(removed, F.col("rows_before")), F.lit(0.0)).alias("pct_removed"),
    )


def completeness(df: DataFrame, columns=SELECTED_COLUMNS) -> DataFrame:
    """Non-null values and their share per column; the share of no rows is NULL."""
    wide = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    return wide.unpivot("_rows", list(columns), "column_name", "n_non_null").select(
        "column_name",
        "n_non_null",
        F.round(F.try_divide("n_non_null", "_rows"), 4).alias("rate"),
    )


def _violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count per rule from one aggregate over the rows."""
    return df.agg(*[rule.alias(name) for name, rule in rules.items()]).unpivot(
        [], list(rules), "rule", "violations"
    )


def _empty() -> Column:
    return F.when(F.count("*") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def validation_report(raw: DataFrame) -> DataFrame:
    """Violations of the input rules: critical nulls, text and numbers that do not parse, no rows."""
    parsed = {
        **{c: P.parse_number(F.col(c)) for c in NUMERIC_COLUMNS},
        "term": P.parse_term(F.col("term")),
        "int_rate": P.parse_percent(F.col("int_rate")),
        "emp_length": P.parse_emp_length(F.col("emp_length")),
        "revol_util": P.parse_percent(F.col("revol_util")),
        "issue_d": P.parse_issue_date(F.col("issue_d")),
    }
    rules = {f"missing_{c}": F.count_if(F.col(c).isNull()) for c in [KEY, *REQUIRED_COLUMNS]}
    for c, value in parsed.items():
        rules[f"unparsed_{c}"] = F.count_if((F.col(c).cast("string") != "") & value.isNull())
    rules["empty_input"] = _empty()
    rules["empty_output"] = F.when(F.count_if(is_complete()) == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return _violations(raw.transform(select_columns), rules)


def malformed_report(good: DataFrame, malformed: DataFrame) -> DataFrame:
    """Records by ``rule``, the well-formed ones under ``none``; a rule that nothing breaks has 0."""
    rules = [TOO_SHORT, TOO_LONG, UNCLOSED]
    broken = malformed.agg(*[F.count_if(F.col("rule") == r).alias(r) for r in rules])
    counts = broken.unpivot([], rules, "rule", "records")
    return counts.unionByName(good.agg(F.lit("none").alias("rule"), F.count("*").alias("records")))


def output_validation(clean: DataFrame) -> DataFrame:
    """Violations of the output rules: critical nulls, flag values, repeated ids, no rows."""
    # Rows are first counted per id on the map side, so a repeated id is no hot spot.
    checks = {
        "missing_loan_status": F.col("loan_status").isNull(),
        "missing_annual_inc": F.col("annual_inc").isNull(),
        "invalid_is_default": F.col("is_default").isNull() | ~F.col("is_default").isin(0, 1),
    }
    per_id = clean.groupBy(KEY).agg(
        F.count("*").alias("n"), *[F.count_if(broken).alias(name) for name, broken in checks.items()]
    )
    rules = {name: F.coalesce(F.sum(name), F.lit(0)) for name in checks}
    rules["repeated_id"] = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    rules["empty_output"] = _empty()
    return _violations(per_id, rules)
