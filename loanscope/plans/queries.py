"""The queries the driver runs; each takes a session and a table folder."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.operators import merging, quality, reports, sketches
from loanscope.operators.cleaning import add_features, clean_loans, dedup_by_id, required_filter, select_columns
from loanscope.operators.joins import join_lookup
from loanscope.plans.incremental import NO_YEAR, read_years, refresh_years
from loanscope.plans.loan_view import loan_view
from loanscope.plans.pipeline import run_pipeline
from loanscope.plans.stand_ins import DAMAGE, LATER
from loanscope.schema import KEY, PREVIEW_COLUMNS, SELECTED_COLUMNS, STATISTIC_COLUMNS, TEXT_COLUMNS
from loanscope.sources.compaction import LEAST, MOST, compact
from loanscope.sources.formats import CSV
from loanscope.sources.inference import inferred_types
from loanscope.sources.manifest import checked_manifest, input_manifest, output_manifest, rows_per_file
from loanscope.sources.readers import read_csv, read_loans, read_processed
from loanscope.sources.records import read_split_csv
from loanscope.sources.scratch import scratch_path
from loanscope.sources.writers import write_loans, write_quarantine

#: Cuts the files of the smallest tables already.
RECORDS_PER_FILE = 1000
#: Gives the smallest tables several files already.
TARGET_BYTES = 1 << 17

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_view(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_view(spark, sf_dir).transform(clean_loans)


# --- Scans and sinks: written to a new folder, then read back ---


def _written_raw(spark: SparkSession, sf_dir: str, fmt: str, **options) -> str:
    path = scratch_path(spark, fmt)
    write_loans(raw(spark, sf_dir).transform(select_columns), path, fmt, **options)
    return path


def _written_clean(spark: SparkSession, sf_dir: str, fmt: str, **options) -> str:
    path = scratch_path(spark, fmt)
    write_loans(clean(spark, sf_dir), path, fmt, **options)
    return path


def scan_csv(spark, sf_dir):
    return read_loans(spark, _written_raw(spark, sf_dir, "csv")).transform(select_columns)


def scan_csv_split(spark, sf_dir):
    """The raw table from files that are read in splits, line breaks in values and all."""
    return read_split_csv(spark, _written_raw(spark, sf_dir, "csv"))[0].transform(select_columns)


def _damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw table as CSV lines without a header, some of them damaged."""
    loans = raw(spark, sf_dir).transform(select_columns)
    line = F.to_csv(F.struct(*[F.coalesce(c, F.lit("")) for c in loans.columns]), {"quoteAll": "true"} | {k: str(v) for k, v in CSV.items() if k != "header"})
    amount = F.coalesce(F.col("loan_amnt").try_cast("bigint"), F.lit(0))
    damage = DAMAGE.items()
    kind = F.expr("CASE " + " ".join(f"WHEN {when} THEN '{name}'" for name, when in damage) + " END")
    lines = loans.select(amount.alias("amount"), line.alias("line")).withColumn("kind", kind)
    path = scratch_path(spark, "damaged")
    damaged = F.expr(
        """CASE kind WHEN 'too_short' THEN '"1","2",3' WHEN 'too_long' THEN concat(line, ',more') ELSE line END"""
    )
    # All lines come from one pass; those of the few records left open are written as hexadecimal digits, which have no line ends.
    held = F.expr("""CASE WHEN kind <=> 'unclosed' THEN hex(concat(line, ',"never closed')) ELSE damage END""")
    values = lines.withColumn("damage", damaged).select(held.alias("value"), F.expr("kind <=> 'unclosed'").alias("unclosed"))
    values.write.partitionBy("unclosed").option("lineSep", "\n").text(path)
    # A quote that nothing closes takes the rest of its file, so these come last in files of their own.
    unclosed = spark.read.schema("value string, unclosed boolean").text(path).where("unclosed")
    unclosed = unclosed.select(F.unhex("value").cast("string").alias("value"))
    path = f"{path}/unclosed=false"
    unclosed.write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return path


def malformed_records(spark, sf_dir):
    """Records that do not fit their columns, set aside by rule and counted there, and the rows that stay."""
    good, malformed = read_split_csv(spark, _damaged_csv(spark, sf_dir), SELECTED_COLUMNS)
    path = scratch_path(spark, "quarantine")
    write_quarantine(malformed, path)
    aside = spark.read.schema("rule string, file string, record string").json(path)
    return quality.malformed_report(good, aside)


def well_formed_rows(spark, sf_dir):
    """The rows of the same files that are as they should be."""
    return read_split_csv(spark, _damaged_csv(spark, sf_dir), SELECTED_COLUMNS)[0]


def scan_csv_inferred(spark, sf_dir):
    return read_csv(spark, _written_raw(spark, sf_dir, "csv"), schema=None)


def scan_processed(spark, sf_dir):
    return read_processed(spark, _written_clean(spark, sf_dir, "csv"), "csv")


def scan_year_partition(spark, sf_dir):
    path = _written_clean(spark, sf_dir, "csv", partition_by_year=True)
    return read_processed(spark, path, "csv").where(F.col("year") == 1997)


def csv_roundtrip(spark, sf_dir):
    path = _written_raw(spark, sf_dir, "csv", max_records_per_file=RECORDS_PER_FILE)
    return read_loans(spark, path, "csv").transform(select_columns)


def _roundtrip(fmt: str) -> Query:
    return lambda spark, sf_dir: read_loans(spark, _written_raw(spark, sf_dir, fmt), fmt).transform(select_columns)


def partitioned_roundtrip(spark, sf_dir):
    return read_processed(spark, _written_clean(spark, sf_dir, "parquet", partition_by_year=True))


def input_rows(spark, sf_dir):
    orders, customer = (rows_per_file(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in ("orders", "customer"))
    return orders.union(customer)


def output_files(spark, sf_dir):
    return output_manifest(spark, _written_clean(spark, sf_dir, "csv"))


def output_listing(spark, sf_dir):
    """What holds of a listing whatever the files are called: a bound on records gives several, all of them CSV."""
    path = _written_raw(spark, sf_dir, "csv", max_records_per_file=RECORDS_PER_FILE)
    listed = output_manifest(spark, path).first()
    largest = input_manifest(spark, path).agg(F.max("length")).first()[0]
    n_rows = read_loans(spark, path, "csv").agg(F.count("*").alias("n_rows"))
    return n_rows.select(
        "n_rows",
        F.lit(listed["csv_files"] > 1).alias("several_files"),
        F.lit(listed["csv_files"] == listed["total_files"]).alias("all_files_csv"),
        F.lit(listed["main_file_bytes"] == largest).alias("main_file_is_largest"),
    )


def _compacted(spark: SparkSession, sf_dir: str) -> str:
    """The raw table as many small CSV files, put together to files of a wanted size."""
    small = _written_raw(spark, sf_dir, "csv", max_records_per_file=RECORDS_PER_FILE)
    path = scratch_path(spark, "compacted")
    compact(spark, small, path, "csv", TARGET_BYTES)
    return path


def compacted_rows(spark, sf_dir):
    return read_loans(spark, _compacted(spark, sf_dir)).transform(select_columns)


def compacted_listing(spark, sf_dir):
    """Whether the files have the wanted size, and what they hold."""
    path = _compacted(spark, sf_dir)
    size = F.col("length") / TARGET_BYTES
    listed = input_manifest(spark, path).agg(F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most")).first()
    return read_loans(spark, path).agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(listed["n"] > 1).alias("several_files"),
        F.lit(listed["least"] >= LEAST and listed["most"] <= MOST).alias("sizes_in_bounds"),
    )


def input_check(spark, sf_dir):
    """Files of two given tables, with the rows and the content that a scan reads from them."""
    checked = []
    for name in ("orders", "customer"):
        path = f"{sf_dir}/{name}.parquet"
        checked.append(checked_manifest(spark, path, spark.read.parquet(path)).drop("length"))
    return checked[0].union(checked[1])


def column_types(spark, sf_dir):
    """The types that fit the raw table written as CSV."""
    return inferred_types(read_csv(spark, _written_raw(spark, sf_dir, "csv")))


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, list[int]]:
    """A table in year folders, begun from an earlier version of the loans and brought up to date; the years rewritten."""
    path, loans = scratch_path(spark, "years"), raw(spark, sf_dir)
    refresh_years(loans.where(f"NOT {LATER}"), path, first=True)
    return path, refresh_years(loans, path)


def incremental_years(spark, sf_dir):
    return read_years(spark, _refreshed(spark, sf_dir)[0])


def refreshed_years(spark, sf_dir):
    path, written = _refreshed(spark, sf_dir)
    year = F.coalesce("year", F.lit(NO_YEAR)).alias("year")
    return read_years(spark, path).select(year).distinct().withColumn("rewritten", F.col("year").isin(written))


# --- Row operators and single features ---


def _on_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(raw(spark, sf_dir))


def _on_clean(report: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """A report over the cleaned columns it uses, or over all of them."""
    return lambda spark, sf_dir: report(clean_loans(raw(spark, sf_dir), columns or None))


def _feature(*columns: str) -> Query:
    """Some cleaned columns by id."""
    return lambda spark, sf_dir: clean_loans(raw(spark, sf_dir), columns)


def _deduplicated(df: DataFrame) -> DataFrame:
    return df.transform(select_columns).transform(required_filter).transform(dedup_by_id)


def broadcast_join(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    on = orders["o_custkey"] == customer["c_custkey"]
    return join_lookup(orders, customer, on).select("o_orderkey", "c_name", "c_mktsegment")


def phase_metrics(spark, sf_dir):
    """The whole job, its reports saved, timed by phase."""
    source = _written_raw(spark, sf_dir, "csv")
    run = run_pipeline(spark, source, scratch_path(spark, "out"), reports_path=scratch_path(spark, "reports"))
    return run.phases


def phase_rows(spark, sf_dir):
    return phase_metrics(spark, sf_dir).select("phase", "rows")


def _faulty(df: DataFrame) -> DataFrame:
    """Features of all raw rows, copies and incomplete ones included, with a flag that is none in some."""
    flag = F.when(F.col("grade") == "C", F.lit(2)).otherwise(F.col("is_default"))
    return df.transform(select_columns).transform(add_features).withColumn("is_default", flag)


def _on_written(report: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """A report that reads its table several times: the cleaned columns are written once before."""

    def query(spark, sf_dir):
        path = scratch_path(spark, "clean")
        write_loans(clean_loans(raw(spark, sf_dir), columns), path)
        return report(spark.read.parquet(path))

    return query


def sketch_quartiles(spark, sf_dir):
    """Quartiles over all years, merged from a sketch per year: are their ranks as near as promised?"""
    path = scratch_path(spark, "clean")
    write_loans(clean_loans(raw(spark, sf_dir), [*STATISTIC_COLUMNS, "year"]), path)
    loans = spark.read.parquet(path)
    quartiles = sketches.merged_quantiles(sketches.year_sketches(loans), [0.25, 0.5, 0.75])
    errors = sketches.rank_errors(loans, quartiles)
    return errors.select("column_name", "probability", (F.col("error") <= sketches.RANK_ERROR).alias("within_bound"))


def _stored(state: DataFrame) -> DataFrame:
    """A state written and read again, as a report of a later day finds it."""
    path = scratch_path(state.sparkSession, "state")
    state.write.parquet(path)
    return state.sparkSession.read.parquet(path)


def merged_summary(spark, sf_dir):
    loans = clean_loans(raw(spark, sf_dir), [*STATISTIC_COLUMNS, "is_default", "year"])
    return merging.merged_summary(_stored(merging.moment_state(loans)))


def merged_top10(spark, sf_dir):
    loans = clean_loans(raw(spark, sf_dir), ["is_default", "grade", "purpose", "year"])
    return reports.purpose_top(merging.merged_counts(_stored(merging.count_state(loans))))


def merged_years(spark, sf_dir):
    loans = clean_loans(raw(spark, sf_dir), ["is_default", "grade", "purpose", "year"])
    return reports.year_distribution(merging.merged_counts(_stored(merging.count_state(loans))))


QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "scan_csv_split": scan_csv_split,
    "scan_csv_inferred": scan_csv_inferred,
    "scan_processed": scan_processed,
    "scan_year_partition": scan_year_partition,
    "csv_roundtrip": csv_roundtrip,
    "orc_roundtrip": _roundtrip("orc"),
    "json_roundtrip": _roundtrip("json"),
    "parquet_roundtrip": _roundtrip("parquet"),
    "partitioned_roundtrip": partitioned_roundtrip,
    "input_manifest": input_manifest,
    "input_rows": input_rows,
    "input_check": input_check,
    "column_types": column_types,
    "compacted_rows": compacted_rows,
    "compacted_listing": compacted_listing,
    "incremental_years": incremental_years,
    "refreshed_years": refreshed_years,
    "output_manifest": output_files,
    "output_listing": output_listing,
    "select_columns": _on_raw(select_columns),
    "required_filter": _on_raw(lambda df: df.transform(select_columns).transform(required_filter)),
    "dedup_by_id": _on_raw(_deduplicated),
    "parse_term": _feature("term"),
    "parse_int_rate": _feature("int_rate"),
    "parse_revol_util": _feature("revol_util"),
    "parse_emp_length": _feature("emp_length"),
    "parse_issue_date": _feature("issue_d"),
    "default_flag": _feature("is_default"),
    "fico_avg": _feature("fico_avg"),
    "income_to_loan_ratio": _feature("income_to_loan_ratio"),
    "issue_year": _feature("year"),
    "normalize_text": _feature(*TEXT_COLUMNS),
    "clean_loans": clean,
    "preview": _on_clean(reports.preview, *PREVIEW_COLUMNS),
    "row_count": _on_clean(reports.row_count, KEY),
    "row_loss": _on_raw(quality.row_loss),
    "default_distribution": _on_clean(reports.default_distribution, "is_default"),
    "year_distribution": _on_clean(reports.year_distribution, "year"),
    "grade_distribution": _on_clean(reports.grade_distribution, "grade"),
    "grade_top10": _on_clean(reports.grade_top, "grade"),
    "purpose_top10": _on_clean(reports.purpose_top, "purpose"),
    "numeric_describe": _on_clean(reports.numeric_describe, *STATISTIC_COLUMNS),
    "key_metrics": _on_clean(reports.key_metrics, "loan_amnt", "int_rate", "fico_avg"),
    "distinct_years": _on_clean(reports.distinct_years, "year"),
    "year_coverage": _on_clean(reports.year_coverage, "year"),
    "loan_amnt_stats": _on_written(reports.loan_amnt_stats, "loan_amnt"),
    "int_rate_stats": _on_written(reports.int_rate_stats, "int_rate"),
    "fico_stats": _on_written(reports.fico_stats, "fico_avg"),
    "numeric_quartiles": _on_written(reports.numeric_quartiles, *STATISTIC_COLUMNS),
    "default_correlations": _on_clean(reports.default_correlations, *STATISTIC_COLUMNS, "is_default"),
    "default_rate": _on_clean(reports.default_rate, "is_default"),
    "portfolio_summary": _on_written(reports.portfolio_summary, *STATISTIC_COLUMNS, "is_default"),
    "sketch_quartiles": sketch_quartiles,
    "merged_summary": merged_summary,
    "merged_top10": merged_top10,
    "merged_years": merged_years,
    "run_summary": lambda spark, sf_dir: reports.run_summary(clean(spark, sf_dir), "loans"),
    "completeness": _on_raw(quality.completeness),
    "validation_report": _on_raw(quality.validation_report),
    "malformed_records": malformed_records,
    "well_formed_rows": well_formed_rows,
    "output_validation": _on_raw(lambda df: quality.output_validation(_faulty(df))),
    "phase_metrics": phase_metrics,
    "phase_rows": phase_rows,
    "broadcast_join": broadcast_join,
}
