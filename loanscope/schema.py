"""Loan table schemas and the fixed values the cleaning rules depend on."""

from pyspark.sql import types as T

# --- Fixed values: results depend on these exact columns, words and patterns ---

SELECTED_COLUMNS = [
    "id", "loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
    "emp_length", "home_ownership", "annual_inc", "verification_status",
    "loan_status", "purpose", "dti", "delinq_2yrs", "fico_range_low",
    "fico_range_high", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "issue_d", "addr_state",
]
DERIVED_COLUMNS = ["is_default", "fico_avg", "income_to_loan_ratio", "year"]
REQUIRED_COLUMNS = ["loan_status", "annual_inc", "issue_d"]
TEXT_COLUMNS = [
    "grade", "sub_grade", "home_ownership", "verification_status",
    "loan_status", "purpose", "addr_state",
]
STATISTIC_COLUMNS = [
    "loan_amnt", "int_rate", "annual_inc", "dti", "fico_avg", "income_to_loan_ratio",
]
PREVIEW_COLUMNS = ["loan_amnt", "int_rate", "grade", "is_default", "fico_avg", "year"]
DEFAULT_STATUSES = ["Charged Off", "Default"]
INTEGER_PATTERN = r"(\d+)"
DECIMAL_PATTERN = r"([\d.]+)"
ISSUE_DATE_FORMAT = "MMM-yyyy"
EMP_LENGTH_MARKERS = {"10+": 10, "< 1": 0}  # first marker found wins
STRONG_CORRELATION = 0.3
MODERATE_CORRELATION = 0.1

# --- Schemas ---

KEY = "id"

NUMERIC_COLUMNS = [
    "loan_amnt", "installment", "annual_inc", "dti", "delinq_2yrs", "fico_range_low",
    "fico_range_high", "open_acc", "pub_rec", "revol_bal", "total_acc",
]

# Numbers are read as text too: a malformed one can then be told from a missing one.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SELECTED_COLUMNS])

_CLEANED_TYPES = {
    **{c: T.DoubleType() for c in NUMERIC_COLUMNS},
    "term": T.IntegerType(),
    "int_rate": T.DoubleType(),
    "emp_length": T.IntegerType(),
    "revol_util": T.DoubleType(),
    "issue_d": T.DateType(),
}

CLEAN_SCHEMA = T.StructType(
    [T.StructField(c, _CLEANED_TYPES.get(c, T.StringType())) for c in SELECTED_COLUMNS]
    + [
        T.StructField("is_default", T.IntegerType()),
        T.StructField("fico_avg", T.IntegerType()),
        T.StructField("income_to_loan_ratio", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
    ]
)

CLEAN_COLUMNS = CLEAN_SCHEMA.fieldNames()
