"""Loan table sinks."""

from pyspark.sql import DataFrame

from loanscope.sources.formats import CSV, check_format


def write_loans(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by_year: bool = False,
    n_files: int | None = None,
    max_records_per_file: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Writes a loan table as CSV, JSON, ORC or Parquet.

    ``partition_by_year`` writes one folder per year. The rows are rebalanced by
    year first: each task then writes few folders, and adaptive execution splits
    a year that holds a large share of the rows over several tasks.

    ``n_files`` sets the number of files, after a shuffle that keeps the work
    before it at full width. It must be at least 2: a single file would pass
    the whole table through one task. ``max_records_per_file`` bounds the files
    without any shuffle.
    """
    check_format(fmt)
    if n_files is not None and n_files < 2:
        raise ValueError("n_files must be at least 2; one file would pass the whole table through one task")
    if n_files is not None and partition_by_year:
        raise ValueError("n_files and partition_by_year exclude each other")
    if partition_by_year:
        df = df.hint("rebalance", "year")
    elif n_files is not None:
        df = df.repartition(n_files)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV)
    elif fmt == "parquet":
        writer = writer.option("compression", "snappy")
    if partition_by_year:
        writer = writer.partitionBy("year")
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def write_report(table: DataFrame, path: str) -> None:
    """Saves a report as JSON, NULL values included."""
    table.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_quarantine(malformed: DataFrame, path: str) -> None:
    """Saves records set aside as JSON, a folder per rule that they break."""
    malformed.write.mode("overwrite").partitionBy("rule").json(path)
