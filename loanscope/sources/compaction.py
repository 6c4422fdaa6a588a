"""Output files of a wanted size.

Files of a written table lie end to end on a line of bytes, which is cut into
equal bins of about the wanted size. Each row gets a place at random in the
stretch of its file, hence a bin: small files fall into one bin together, a large
one is dealt over several, and every bin is one task and one file.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanscope.sources.formats import check_format
from loanscope.sources.manifest import input_manifest
from loanscope.sources.readers import read_loans
from loanscope.sources.scratch import work_folder
from loanscope.sources.writers import write_loans

#: Files lie between these multiples of the wanted size.
LEAST, MOST = 0.5, 1.5
ATTEMPTS = 4


def _sizes(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes of all files of a table, of the smallest and of the largest."""
    listed = input_manifest(spark, path).agg(F.sum("length"), F.min("length"), F.max("length")).first()
    return tuple(x or 0 for x in listed)


def compact(spark: SparkSession, source: str, path: str, fmt: str, target_bytes: int, seed: int = 0) -> int:
    """Rewrites a table in files of between half and one and a half ``target_bytes``; returns their number.

    The number of files comes from the written size, and is corrected by what the
    new files take, since larger files compress better. A table under one and a
    half ``target_bytes`` becomes one file. Rows stay the same, their order does not.
    ``source`` is left as it is; ``path`` must lie elsewhere.
    """
    check_format(fmt)
    if target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    total = _sizes(spark, source)[0]
    # A row per file; the running total is the only window over all of them.
    end = F.sum("length").over(Window.orderBy("path"))
    stretch = input_manifest(spark, source).select("path", "length", (end - F.col("length")).alias("begin"))
    rows = read_loans(spark, source, fmt)
    columns = rows.columns
    # The seeded numbers of a scan are the same when a task runs again.
    placed = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.rand(seed).alias("_at"))
    placed = placed.join(stretch.select(F.col("path").alias("_path"), "begin", "length"), "_path")
    size = total
    for _ in range(ATTEMPTS):
        n = max(1, round(size / target_bytes))
        at = (F.col("begin") + F.col("_at") * F.col("length")) * (n / max(1, total))
        binned = placed.withColumn("_bin", F.least(F.floor(at), F.lit(n - 1)).cast("int"))
        write_loans(binned.repartitionById(n, F.col("_bin")).select(*columns), path, fmt)
        size, smallest, largest = _sizes(spark, path)
        if n == 1 and size <= MOST * target_bytes or smallest >= LEAST * target_bytes and largest <= MOST * target_bytes:
            break
    return n


def write_sized(df: DataFrame, path: str, fmt: str, target_bytes: int) -> int:
    """Writes a table in files of about ``target_bytes``; returns their number.

    It is written to the shared folder first, as its tasks leave it, which tells its size.
    """
    with work_folder(df.sparkSession) as work:
        write_loans(df, f"{work}/staged", fmt)
        return compact(df.sparkSession, f"{work}/staged", path, fmt, target_bytes)
