"""Write the final (adaptive) physical plans of the headline queries.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
Each query runs once (collect at sf0.01), then its executed plan is printed,
so the plans show AQE's final choices (coalesced partitions, codegen spans).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from argent.plans.registry import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    cases = {k: QUERIES[k](spark, sf_dir) for k in ("sales_pipeline", "customer_pipeline", "sales_quality")}
    print(f"# Physical plans\n\nFinal adaptive plans after one run on `{sf_dir}`, "
          "generated by `tools/show_plans.py`.\n")
    for name, df in cases.items():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        print(f"## {name}\n\n```\n{plan.strip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
