"""Column types from text, as a lattice merged in one aggregate.

Every value has a kind, a column the set of kinds of its values, and sets merge
by union, in any order and in any number of tasks. The type of a column is the
smallest that holds all its kinds.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT, BIGINT, DOUBLE, DATE, BOOLEAN, STRING = (1 << i for i in range(6))
#: Types from the narrowest on, with the kinds each holds.
LATTICE = {
    "int": INT,
    "bigint": INT | BIGINT,
    "double": INT | BIGINT | DOUBLE,
    "date": DATE,
    "boolean": BOOLEAN,
    "string": INT | BIGINT | DOUBLE | DATE | BOOLEAN | STRING,
}
# --- Fixed values: how values of a kind are written ---
WHOLE = r"^[+-]?\d{1,18}$"
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
TRUTH = r"^(true|false)$"


def kind(text: Column) -> Column:
    """The kind of a value; a missing or empty one has none."""
    number = F.when(text.rlike(WHOLE), text).try_cast("bigint")
    return (
        F.when(text.isNull() | (text == ""), 0)
        .when(number.between(-(2**31), 2**31 - 1), INT)
        .when(number.isNotNull(), BIGINT)
        .when(text.rlike(DECIMAL), DOUBLE)
        .when(text.rlike(DAY) & text.try_cast("date").isNotNull(), DATE)
        .when(F.lower(text).rlike(TRUTH), BOOLEAN)
        .otherwise(STRING)
    )


def _name(kinds: Column) -> Column:
    """The first type of the lattice that holds all kinds; text for a column without values."""
    named = F.when(kinds == 0, F.lit("string"))
    for name, holds in LATTICE.items():
        named = named.when(kinds.bitwiseAND(F.lit(STRING * 2 - 1 - holds)) == 0, name)
    return named


def inferred_types(text: DataFrame) -> DataFrame:
    """``column_name`` and ``type`` of every column of a table of text, from one aggregate over it."""
    kinds = [F.coalesce(F.bit_or(kind(F.col(f"`{c}`"))), F.lit(0)).alias(c) for c in text.columns]
    merged = text.agg(*kinds).unpivot([], [F.col(f"`{c}`") for c in text.columns], "column_name", "kinds")
    return merged.select("column_name", _name(F.col("kinds")).alias("type"))


def infer_schema(text: DataFrame) -> T.StructType:
    """The schema that fits a table of text; a row per column comes to the driver."""
    found = {r["column_name"]: r["type"] for r in inferred_types(text).collect()}
    return T.StructType([T.StructField(c, T.DataType.fromDDL(found[c])) for c in text.columns])
