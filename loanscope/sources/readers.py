"""Loan table scans."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanscope.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, RAW_SCHEMA
from loanscope.sources.formats import COLUMNAR, CSV, check_format


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = RAW_SCHEMA,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header, quoted fields and doubled quotes.

    ``schema`` gives the types of the columns it names, found by the header;
    other columns are text. ``schema=None`` infers all types from the data, at
    the price of one more pass.

    ``multi_line`` allows line breaks inside quotes. A file is then read by one
    task, so large inputs should come as many files; without such line breaks,
    ``multi_line=False`` splits files as well.
    """
    # Columns bind by position, so every file must have this header or fail.
    reader = spark.read.options(**CSV, multiLine=multi_line, enforceSchema=False)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    text = reader.csv(path)
    typed = {f.name: f.dataType for f in schema if f.dataType != T.StringType()}
    return text.withColumns({c: F.col(c).try_cast(typed[c]) for c in text.columns if c in typed})


def read_loans(spark: SparkSession, path: str, fmt: str = "csv", **csv_options) -> DataFrame:
    """Raw loan table. JSON is read with the declared schema, never inferred.

    ORC and Parquet files may lack different columns: theirs are merged, a
    missing one is NULL in the rows of a file without it.
    """
    if check_format(fmt) == "csv":
        return read_csv(spark, path, **csv_options)
    if fmt in COLUMNAR:
        return spark.read.format(fmt).option("mergeSchema", True).load(path)
    return spark.read.schema(RAW_SCHEMA).json(path)


def read_processed(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = True) -> DataFrame:
    """Cleaned loan table: every file under ``path``, also one folder per year.

    A filter on ``year`` prunes such folders. Columns come in the clean order,
    because a folder column is read back last.
    """
    if check_format(fmt) == "csv":
        df = read_csv(spark, path, CLEAN_SCHEMA, multi_line)
    else:
        df = spark.read.schema(CLEAN_SCHEMA).format(fmt).load(path)
    return df.select(*CLEAN_COLUMNS)
