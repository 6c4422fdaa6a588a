"""Column expressions that clean one loan field or derive one feature.

All are built-in expressions, so they stay inside whole-stage code generation.
They never raise under ANSI mode: text that does not parse becomes NULL.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanscope.schema import (
    DECIMAL_PATTERN,
    DEFAULT_STATUSES,
    EMP_LENGTH_MARKERS,
    INTEGER_PATTERN,
    ISSUE_DATE_FORMAT,
)


def first_integer(text: Column) -> Column:
    """First run of digits as an integer."""
    return F.regexp_extract(text.cast("string"), INTEGER_PATTERN, 1).try_cast("int")


def first_decimal(text: Column) -> Column:
    """First run of digits and points as a double; ``1.2.3`` gives NULL."""
    return F.regexp_extract(text.cast("string"), DECIMAL_PATTERN, 1).try_cast("double")


def parse_number(value: Column) -> Column:
    """Text to a double; takes an already numeric column as well."""
    return value.try_cast("double")


def parse_term(term: Column) -> Column:
    return first_integer(term)


def parse_percent(rate: Column) -> Column:
    """``13.99%`` or ``13.99`` to 13.99; also takes an already numeric column."""
    return first_decimal(rate)


def parse_emp_length(emp_length: Column) -> Column:
    """Years in employment; the marker words win over the plain number."""
    text = emp_length.cast("string")
    # Every branch is an integer: mixed branches change type between ANSI modes.
    marked = [F.when(text.contains(word), F.lit(years)) for word, years in EMP_LENGTH_MARKERS.items()]
    return F.coalesce(*marked, first_integer(text))


def parse_issue_date(issue_d: Column) -> Column:
    """Month and year text to the first day of that month."""
    return F.try_to_date(issue_d, ISSUE_DATE_FORMAT)


def default_flag(loan_status: Column) -> Column:
    """1 for an exact default status, else 0, also for NULL.

    Meant for the raw status: padded or other-case text does not count.
    """
    return F.coalesce(loan_status.isin(DEFAULT_STATUSES).cast("int"), F.lit(0))


def fico_avg(low: Column, high: Column) -> Column:
    """Midpoint of the score range, halves rounded up; NULL if a bound is."""
    return F.round((low + high) / 2, 0).try_cast("int")


def income_to_loan_ratio(annual_inc: Column, loan_amnt: Column) -> Column:
    """Income over amount to 2 decimals; NULL unless the amount is positive."""
    return F.when(loan_amnt > 0, F.round(annual_inc / loan_amnt, 2))


def issue_year(issue_date: Column) -> Column:
    return F.year(issue_date)


def normalize_text(text: Column) -> Column:
    """Upper case without leading or trailing spaces; other blanks stay."""
    return F.upper(F.trim(text))
