"""spark-submit entry: raw CSV (file or folder) in, published table and reports out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from breachlens.batch import run_batch
from breachlens.schema import REFERENCE_DATE, TABLE_NAME


def main() -> None:
    parser = argparse.ArgumentParser(prog="breachlens", description=__doc__)
    parser.add_argument("source", help="CSV file or folder")
    parser.add_argument("target", help="folder for layers, table versions and reports")
    parser.add_argument("--reference-date", default=REFERENCE_DATE)
    parser.add_argument("--table", default=TABLE_NAME)
    parser.add_argument("--export-csv", action="store_true")
    parser.add_argument(
        "--multi-line", action=argparse.BooleanOptionalAction, help="whether quoted cells hold line breaks (default: look)"
    )
    given = parser.parse_args()
    spark = SparkSession.builder.appName("breachlens").getOrCreate()
    result = run_batch(
        spark,
        given.source,
        given.target,
        reference_date=given.reference_date,
        table_name=given.table,
        multi_line=given.multi_line,
        export_csv=given.export_csv,
    )
    for name, value in result.summary.items():
        print(f"{name}: {value}")


if __name__ == "__main__":
    main()
