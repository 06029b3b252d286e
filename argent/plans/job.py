"""The whole bronze -> silver job: customers from Parquet, sales from CSV."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from argent.plans.quality import observed_customer_pipeline, observed_sales_pipeline
from argent.sinks.writers import write_path
from argent.sources.scans import read_csv, read_parquet


@dataclass(frozen=True)
class SilverTables:
    """Where the two tables are, and the counters of the run that wrote them
    (none for a table that ``mode="ignore"`` left alone)."""

    customers: str
    sales: str
    customer_quality: dict[str, int]
    sales_quality: dict[str, int]


def bronze_to_silver(
    spark: SparkSession,
    customer_source: str,
    sales_source: str,
    output: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    date_mode: str = "parse_first",
) -> SilverTables:
    """Scan -> clean -> write, once per entity: a one-row source check, then
    one write, which counts as it goes. Customers run first; if sales fails,
    customers is already written."""
    out = output.rstrip("/")
    raw = {
        "customers": read_parquet(spark, customer_source),
        "sales": read_csv(spark, sales_source, header=True, infer_schema=False, delimiter=","),
    }
    plans = {
        "customers": observed_customer_pipeline(raw["customers"]),
        "sales": observed_sales_pipeline(raw["sales"], date_mode=date_mode),
    }
    counters = [
        seen.report() if write_path(silver, f"{out}/{name}", fmt=fmt, mode=mode) else {}
        for name, (silver, seen) in plans.items()
    ]
    return SilverTables(f"{out}/customers", f"{out}/sales", *counters)
