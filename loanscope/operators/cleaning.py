"""Column selection, row filter, key dedup and the whole cleaning chain."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanscope.functions import parsing as P
from loanscope.schema import (
    CLEAN_COLUMNS,
    KEY,
    NUMERIC_COLUMNS,
    REQUIRED_COLUMNS,
    SELECTED_COLUMNS,
    TEXT_COLUMNS,
)


def select_columns(df: DataFrame) -> DataFrame:
    """The loan columns; a missing column fails here.

    Columns keep their type, numbers or text; what is neither, as a nested value,
    becomes text.
    """
    chosen = df.select(*SELECTED_COLUMNS)
    kept = (T.NumericType, T.StringType)
    other = [f.name for f in chosen.schema if not isinstance(f.dataType, kept) or f.name == KEY]
    return chosen.withColumns({c: F.col(c).cast("string") for c in other})


def required_filter(df: DataFrame) -> DataFrame:
    """Rows that have a status, an income and an issue month; a malformed income is one."""
    return df.where(" AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_COLUMNS))


def row_digest(df: DataFrame) -> Column:
    """128 bits of the whole row but its key, the same for a number read as text and as a number.

    Lengths go before the values, so that these cannot run into each other; a
    missing value has length -1. Numbers take part as the text of a double, and one
    that does not parse as a missing one, as which it is cleaned.
    """
    texts = []
    for c in df.columns:
        if c != KEY:
            value, kind = F.col(f"`{c}`"), df.schema[c].dataType
            if isinstance(kind, T.NumericType) or c in NUMERIC_COLUMNS and kind == T.StringType():
                texts.append(P.parse_number(value).cast("string"))
            else:
                texts.append(value if kind == T.StringType() else value.cast("string"))
    lengths = [F.coalesce(F.octet_length(t), F.lit(-1)).cast("string") for t in texts]
    return F.unhex(F.md5(F.concat_ws("|", *lengths, *texts)))


def _one_per_id(df: DataFrame, digest: str) -> DataFrame:
    """The row with the smallest digest of every id, without the digest."""
    columns = [c for c in df.columns if c != digest]
    smallest = F.min(F.struct(digest, *[F.col(f"`{c}`") for c in columns if c != KEY])).alias(digest)
    return df.groupBy(KEY).agg(smallest).select(*[c if c == KEY else F.col(f"{digest}.`{c}`") for c in columns])


def dedup_by_id(df: DataFrame, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One whole row per ``id``; all rows without an id count as one key.

    Keeps the row with the smallest digest of all its columns, or the first in the
    given order, ties broken by the digest. Numbers read as text count as numbers.
    The choice depends on the data alone, so tasks repeated after a lost executor
    make the same one, which ``dropDuplicates`` does not promise when copies differ.

    Every map task reduces its rows to one per key before the single shuffle, so
    a key that holds a large share of the rows stays cheap.
    """
    marked = df.withColumn("_digest", row_digest(df))
    if order_by:
        first = Window.partitionBy(KEY).orderBy(*order_by, "_digest", *[c for c in df.columns if c != KEY])
        return marked.withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row", "_digest")
    return _one_per_id(marked, "_digest")


def add_features(df: DataFrame, *more: Column) -> DataFrame:
    """Typed fields, derived features and upper-cased text, and more columns of the raw fields, in one projection.

    Every expression reads the raw fields, so the default flag sees the status
    before its text is normalised.
    """
    issue_date = P.parse_issue_date(F.col("issue_d"))
    amount, income = P.parse_number(F.col("loan_amnt")), P.parse_number(F.col("annual_inc"))
    low, high = P.parse_number(F.col("fico_range_low")), P.parse_number(F.col("fico_range_high"))
    cleaned = {
        **{c: P.parse_number(F.col(c)) for c in NUMERIC_COLUMNS},
        "term": P.parse_term(F.col("term")),
        "int_rate": P.parse_percent(F.col("int_rate")),
        "emp_length": P.parse_emp_length(F.col("emp_length")),
        "revol_util": P.parse_percent(F.col("revol_util")),
        "issue_d": issue_date,
        "is_default": P.default_flag(F.col("loan_status")),
        "fico_avg": P.fico_avg(low, high),
        "income_to_loan_ratio": P.income_to_loan_ratio(income, amount),
        "year": P.issue_year(issue_date),
        **{c: P.normalize_text(F.col(c)) for c in TEXT_COLUMNS},
    }
    return df.select(*[cleaned[c].alias(c) if c in cleaned else c for c in CLEAN_COLUMNS], *more)


def clean_loans(
    raw: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The whole chain: select, required filter, one row per id, features.

    Which copy of a loan stays is decided by a digest of its whole raw row, so every
    report of a table speaks of the same loans. ``columns`` asks for some cleaned
    columns besides ``id``, of the same rows: these, the id and the digest are all
    that is sorted and shuffled. ``order_by`` is evaluated on the raw columns.
    """
    rows = required_filter(select_columns(raw))
    asked = None if columns is None else [KEY, *(c for c in columns if c != KEY)]
    if asked is None or order_by:
        cleaned = add_features(dedup_by_id(rows, order_by))
        return cleaned if asked is None else cleaned.select(*asked)
    marked = add_features(rows, row_digest(rows).alias("_digest"))
    return _one_per_id(marked.select(*asked, "_digest"), "_digest")
