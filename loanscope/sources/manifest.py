"""File listings of an input or output folder as DataFrames."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str) -> DataFrame:
    # Only names and sizes are selected, so no file content is read.
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def input_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of each input file; a missing path raises here."""
    return _files(spark, path).select(
        "path",
        "length",
        F.round(F.col("length") / 1024**2, 2).alias("size_mb"),
        F.round(F.col("length") / 1024**3, 2).alias("size_gb"),
        F.when(F.col("length") > 0, "valid").otherwise("empty").alias("status"),
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows of each file that a scan reads; files without rows are not listed."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_rows"))


def file_digests(df: DataFrame) -> DataFrame:
    """``path``, ``n_rows`` and ``digest`` of each file that a scan reads, a sum over its rows whatever their order.

    A row counts with the first 60 bits of the MD5 of its values as text, parted by ``|``, missing ones as ``~``.
    """
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in df.columns]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 15), 16, 10).cast("decimal(28,0)")
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("n_rows"), F.sum(bits).cast("string").alias("digest")
    )


def checked_manifest(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """The files under ``path`` with what a scan of them reads: ``unread`` if it reads no row of a file.

    Digests of two listings tell which files hold other rows than before.
    """
    listed = input_manifest(spark, path).join(file_digests(df), "path", "left")
    return listed.select(
        F.regexp_extract("path", "[^/]*$", 0).alias("file_name"),
        "length",
        F.when(F.col("n_rows").isNull() & (F.col("status") == "valid"), "unread").otherwise(F.col("status")).alias("status"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        "digest",
    )


def output_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Data files of an output folder in one row: CSV files, all files, largest file.

    Marker and checksum files, whose names start with ``_`` or ``.``, are not counted.
    """
    is_csv = F.col("path").rlike(r"\.csv(\.\w+)?$")  # compressed or not
    size = F.struct("length", "path")
    return (
        _files(spark, path)
        .agg(
            F.count_if(is_csv).alias("csv_files"),
            F.count("*").alias("total_files"),
            F.max(F.when(is_csv, size)).alias("main"),
        )
        .select(
            "csv_files",
            "total_files",
            F.col("main.path").alias("main_file"),
            F.coalesce("main.length", F.lit(0)).alias("main_file_bytes"),
        )
    )
