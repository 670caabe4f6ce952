"""Audit a transaction CSV against a vendor-limit CSV: python -m ledgerlens --help"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerlens.plans.audit import run_audit
from ledgerlens.plans.session import SETTINGS


def main() -> None:
    parser = argparse.ArgumentParser(prog="ledgerlens", description="Audit payment transactions.")
    parser.add_argument("--input", required=True, help="transaction CSV file or folder")
    parser.add_argument("--limits", required=True, help="vendor approval limits, CSV file or folder")
    parser.add_argument("--out", required=True, help="folder for the register and the summaries")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"], help="format of the results")
    parser.add_argument("--multiline", action="store_true", help="fields may hold quoted line breaks")
    parser.add_argument("--dates-with-time", action="store_true", help="dates may carry a clock time, which is left out")
    parser.add_argument("--shuffle-partitions", default=SETTINGS["spark.sql.shuffle.partitions"], help="width of shuffles before adaptive execution merges them")
    args = parser.parse_args()

    builder = SparkSession.builder.appName("ledgerlens")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", args.shuffle_partitions).getOrCreate()
    result = run_audit(
        spark,
        args.input,
        args.limits,
        args.out,
        fmt=args.format,
        multiline=args.multiline,
        dates_with_time=args.dates_with_time,
    )
    for table in (result.row_counts, result.by_type, result.data_quality):
        table.show(truncate=False)
    result.discard()


if __name__ == "__main__":
    main()
