"""A clean table in year folders that is brought up to date year by year.

Beside the folders lies a manifest: rows and digest of every year. A refresh
digests the new rows by year in one aggregate and rewrites only the years whose
digest differs; readers take the years of the manifest. The manifest is written
last, so a refresh that fails between leaves years that the next one rewrites.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.operators.cleaning import clean_loans
from loanscope.schema import CLEAN_COLUMNS
from loanscope.sources.readers import read_processed

#: Stands for loans without a year.
NO_YEAR = -1
_MANIFEST = "year int, n_rows bigint, digest string"


def year_digests(clean: DataFrame) -> DataFrame:
    """``year``, ``n_rows`` and ``digest`` of every year, a sum over its rows whatever their order."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in CLEAN_COLUMNS]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 15), 16, 10).cast("decimal(28,0)")
    return clean.groupBy(F.coalesce("year", F.lit(NO_YEAR)).alias("year")).agg(
        F.count("*").alias("n_rows"), F.sum(bits).cast("string").alias("digest")
    )


def _manifest(spark: SparkSession, path: str) -> dict[int, tuple[int, str]]:
    """A row per year."""
    rows = spark.read.schema(_MANIFEST).json(f"{path}/manifest").collect()
    return {r["year"]: (r["n_rows"], r["digest"]) for r in rows}


def refresh_years(raw: DataFrame, path: str, first: bool = False) -> list[int]:
    """Brings the table under ``path`` up to date with ``raw``; returns the years written, ``NO_YEAR`` for none.

    ``first`` begins a new table. Years that hold no loan any more leave the
    manifest, and with it the table. ``raw`` is cleaned twice, once for its digests
    and once, of the years that changed only, for its rows.
    """
    spark, clean = raw.sparkSession, clean_loans(raw)
    now = {r["year"]: (r["n_rows"], r["digest"]) for r in year_digests(clean).collect()}
    before = {} if first else _manifest(spark, path)
    changed = sorted(y for y, seen in now.items() if before.get(y) != seen)
    if changed:
        some = clean.where(F.coalesce("year", F.lit(NO_YEAR)).isin(changed))
        writer = some.hint("rebalance", "year").write.mode("overwrite").partitionBy("year")
        writer.option("partitionOverwriteMode", "static" if first else "dynamic").option("compression", "snappy").parquet(f"{path}/years")
    if now != before or first:
        listed = spark.createDataFrame([(y, n, d) for y, (n, d) in sorted(now.items())], _MANIFEST)
        listed.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return changed


def read_years(spark: SparkSession, path: str, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """The loans of the years of the manifest, from first to last if given; other folders are not read."""
    years = [y for y in _manifest(spark, path) if (first_year is None or y >= first_year) and (last_year is None or y <= last_year)]
    table = read_processed(spark, f"{path}/years")
    listed = F.col("year").isin([y for y in years if y != NO_YEAR])
    return table.where(listed | F.col("year").isNull() if NO_YEAR in years else listed)
