"""Command line for the whole job, e.g. with spark-submit:

    spark-submit --py-files argent.zip -m argent \\
        --customers s3://bucket/bronze/customers/ --sales s3://bucket/bronze/sales/ \\
        --output s3://bucket/silver --format parquet

Prints the silver paths and the quality counters of each table.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from argent.plans.job import bronze_to_silver


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="argent", description="bronze -> silver")
    ap.add_argument("--customers", required=True, help="customer source (Parquet)")
    ap.add_argument("--sales", required=True, help="sales source (CSV with header)")
    ap.add_argument("--output", required=True, help="silver output folder")
    ap.add_argument("--format", default="parquet", help="sink format (parquet, delta, ...)")
    ap.add_argument("--mode", default="overwrite")
    ap.add_argument("--date-mode", default="parse_first", choices=["parse_first", "cast_first"])
    ap.add_argument("--report", action="store_true", help="also print quality counters")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("argent-bronze-to-silver").getOrCreate()
    done = bronze_to_silver(
        spark, args.customers, args.sales, args.output,
        fmt=args.format, mode=args.mode, date_mode=args.date_mode,
    )
    out = {"customers": done.customers, "sales": done.sales}
    if args.report:  # gathered while writing
        out |= {"customer_quality": done.customer_quality, "sales_quality": done.sales_quality}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
