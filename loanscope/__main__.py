"""Batch job: ``spark-submit --py-files … loanscope INPUT OUTPUT [options]``."""

import argparse
import sys

from pyspark.sql import SparkSession

from loanscope.plans.pipeline import run_pipeline
from loanscope.sources.formats import FORMATS


def main(argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="loanscope", description="Clean a loan table and report on it.")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--input-format", choices=FORMATS, default="csv")
    parser.add_argument("--output-format", choices=FORMATS, default="parquet")
    parser.add_argument("--partition-by-year", action="store_true")
    parser.add_argument("--single-line", action="store_true", help="CSV values hold no line breaks: split large files")
    parser.add_argument("--reports", metavar="PATH", help="save every report and the run metrics as JSON here")
    parser.add_argument("--quarantine", metavar="PATH", help="read CSV in splits and set malformed records aside here")
    parser.add_argument("--shuffle-partitions", type=int, help="partitions of a shuffle; else as the session has it")
    parser.add_argument("--split-bytes", type=int, help="most bytes of a scan task; else as the session has it")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("loanscope").getOrCreate()
    try:
        for setting, value in (
            ("spark.sql.shuffle.partitions", args.shuffle_partitions), ("spark.sql.files.maxPartitionBytes", args.split_bytes)
        ):
            if value is not None:
                spark.conf.set(setting, value)
        run = run_pipeline(
            spark,
            args.input,
            args.output,
            input_format=args.input_format,
            output_format=args.output_format,
            partition_by_year=args.partition_by_year,
            reports_path=args.reports,
            quarantine_path=args.quarantine,
            **({"multi_line": not args.single_line} if args.input_format == "csv" else {}),
        )
        print(f"Input read by {run.input_tasks} tasks.")
        run.row_loss.show(truncate=False)
        run.phases.show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
