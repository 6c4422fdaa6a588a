"""The whole job: extract, clean and write, report."""

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.operators import quality, reports
from loanscope.operators.cleaning import clean_loans, select_columns
from loanscope.sources.formats import COLUMNAR, check_format
from loanscope.sources.readers import read_loans, read_processed
from loanscope.sources.records import read_split_csv
from loanscope.sources.scratch import checkpointed, work_folder
from loanscope.sources.writers import write_loans, write_quarantine, write_report

REPORTS_AT_ONCE = 4


@dataclass
class PipelineRun:
    """Tables of one run, over what it wrote. ``input_tasks`` read the input side by side."""

    clean: DataFrame
    row_loss: DataFrame
    phases: DataFrame
    input_tasks: int
    reports: dict[str, DataFrame] = field(default_factory=dict)


def run_pipeline(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    input_format: str = "csv",
    output_format: str = "parquet",
    partition_by_year: bool = False,
    reports_path: str | None = None,
    quarantine_path: str | None = None,
    **csv_options,
) -> PipelineRun:
    """Reads the raw table once, writes the clean table, reports from it.

    Row formats are first copied to Parquet, so that text is parsed once. Tables
    written to shared storage take the place of a cache: a lost executor
    loses none of them, and every later step reads only the columns it needs.
    They lie in a work folder of the run, which is removed when it ends or fails.

    ``reports_path`` saves every report as JSON in a folder of its own. With
    ``quarantine_path`` CSV files are read in splits, line breaks in values and all,
    and records that do not fit their header are set aside there, a folder per rule.
    """
    check_format(input_format)
    check_format(output_format)
    with work_folder(spark) as work:
        started = time.perf_counter()
        raw = _input(spark, input_path, input_format, quarantine_path, csv_options)
        return _run(spark, raw, started, input_path, output_path, input_format, output_format, partition_by_year, reports_path, work)


def _input(spark, path, fmt, quarantine_path, csv_options) -> DataFrame:
    if quarantine_path is None:
        return read_loans(spark, path, fmt, **csv_options)
    if fmt != "csv":
        raise ValueError("only CSV records can be set aside")
    good, malformed = read_split_csv(spark, path)
    write_quarantine(malformed, quarantine_path)
    return good


def _run(spark, raw, started, input_path, output_path, input_format, output_format, partition_by_year, reports_path, work):
    phases: list[tuple[str, float, int]] = []

    def done(phase: str, started: float, rows: int) -> None:
        phases.append((phase, time.perf_counter() - started, rows))

    raw = raw.transform(select_columns)
    input_tasks = raw.rdd.getNumPartitions()  # of the plan; nothing runs for it
    if input_format not in COLUMNAR:
        write_loans(raw, f"{work}/raw")
        raw = read_loans(spark, f"{work}/raw", "parquet")
    # One aggregate over the required columns.
    n_raw, n_filtered = raw.agg(F.count("*"), F.count_if(quality.is_complete())).first()
    done("extract", started, n_raw)

    started = time.perf_counter()
    columnar = output_format in COLUMNAR
    table_path, table_format = (output_path, output_format) if columnar else (f"{work}/clean", "parquet")
    write_loans(clean_loans(raw), table_path, table_format, partition_by_year=partition_by_year and columnar)
    clean = read_processed(spark, table_path, table_format)
    n_clean = clean.count()
    done("transform", started, n_clean)

    # One job transforms and writes a columnar table; both phases then show its time.
    if not columnar:
        started = time.perf_counter()
        write_loans(clean, output_path, output_format, partition_by_year=partition_by_year)
    done("load", started, n_clean)

    counts = spark.range(1).select(
        F.lit(n_raw).alias("n_raw"), F.lit(n_filtered).alias("n_filtered"), F.lit(n_clean).alias("n_unique")
    )
    row_loss = quality.loss_table(counts)
    started = time.perf_counter()
    tables = reports.all_reports(clean)
    tables["output_validation"] = checkpointed(quality.output_validation(clean))
    tables["run_summary"] = reports.run_summary(clean, input_path)
    if reports_path:
        named = {**tables, "row_loss": row_loss}
        paths = [f"{reports_path}/{name}" for name in named]
        # Small independent jobs: run some side by side so that none idles the cluster.
        with ThreadPoolExecutor(REPORTS_AT_ONCE) as pool:
            list(pool.map(write_report, named.values(), paths))
    done("report", started, n_clean)

    if not columnar:  # what outlives the run must not read the work folder
        clean = read_processed(spark, output_path, output_format)
        tables["preview"] = reports.preview(clean)
        tables["run_summary"] = reports.run_summary(clean, input_path)
    metrics = _phase_metrics(spark, phases)
    if reports_path:
        write_report(metrics, f"{reports_path}/phase_metrics")
    return PipelineRun(clean, row_loss, metrics, input_tasks, tables)


def _phase_metrics(spark: SparkSession, phases: list[tuple[str, float, int]]) -> DataFrame:
    measured = spark.createDataFrame(phases, "phase string, seconds double, rows bigint")
    return measured.withColumn("rows_per_second", F.round(F.try_divide("rows", "seconds"), 1))
