"""Bronze (raw) customer and sales views derived from the driver tables.

The driver tables are clean, so these views add dirt with CASE expressions
over *every* row (no rows are filtered out). The same SQL text runs in Spark
and in DuckDB; ``{customer}`` / ``{lineitem}`` are table placeholders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The bronze view definitions used by tests and oracles.
BRONZE_CUSTOMERS_SQL = """
SELECT CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_custkey % 50 = 8 THEN '' WHEN c_custkey % 50 = 17 THEN '   '
  ELSE '  C' || lpad(CAST(c_custkey - (CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END) AS STRING), 6, '0') || ' ' END AS customer_id,
 CASE c_custkey % 7 WHEN 0 THEN ' female ' WHEN 1 THEN 'Male' WHEN 2 THEN 'FEMALE' WHEN 3 THEN 'male' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'Invalid' END AS gender,
 CASE c_custkey % 11 WHEN 3 THEN NULL WHEN 4 THEN '-5' WHEN 5 THEN '150' WHEN 6 THEN 'abc' WHEN 7 THEN '120' WHEN 8 THEN '121' WHEN 9 THEN ' 41.7 ' ELSE CAST(18 + c_custkey % 60 AS STRING) END AS age,
 CASE c_custkey % 5 WHEN 0 THEN ' Credit Card ' WHEN 1 THEN 'Cash' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'Debit Card' END AS payment_method,
 c_mktsegment AS extra_col FROM {customer}
"""

BRONZE_SALES_SQL = """
SELECT CASE WHEN l_partkey % 97 = 5 THEN '' WHEN l_partkey % 97 = 6 THEN NULL ELSE ' I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS invoice_no,
 CASE WHEN l_suppkey % 41 = 3 THEN ' ' ELSE 'C' || CAST(l_suppkey AS STRING) END AS customer_id,
 CASE l_partkey % 9 WHEN 0 THEN 'Clothing' WHEN 1 THEN ' shoes ' WHEN 2 THEN 'BOOKS' WHEN 3 THEN 'Cosmetics' WHEN 4 THEN 'Food & Beverage' WHEN 5 THEN 'Toys' WHEN 6 THEN NULL WHEN 7 THEN '' ELSE 'electronics' END AS category,
 CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 13 = 1 THEN '-3' WHEN l_partkey % 13 = 2 THEN '0' WHEN l_partkey % 13 = 3 THEN 'n/a' WHEN l_partkey % 13 = 4 THEN '2.7' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
 CASE WHEN l_suppkey % 17 = 0 THEN NULL WHEN l_suppkey % 17 = 1 THEN 'NaN' WHEN l_suppkey % 17 = 2 THEN '-10.0' WHEN l_suppkey % 17 = 3 THEN 'free' ELSE CAST(CAST(l_partkey AS STRING) || '.25' AS STRING) END AS price,
 CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 19 = 1 THEN 'bad' WHEN l_partkey % 19 = 2 THEN '31-02-2022' WHEN l_partkey % 19 = 3 THEN CAST(CAST(l_shipdate AS DATE) AS STRING)
  ELSE lpad(CAST(day(l_shipdate) AS STRING),2,'0') || '-' || lpad(CAST(month(l_shipdate) AS STRING),2,'0') || '-' || CAST(year(l_shipdate) AS STRING) END AS invoice_date,
 CASE l_suppkey % 6 WHEN 0 THEN ' Kanyon ' WHEN 1 THEN 'Forum-Istanbul!' WHEN 2 THEN 'İstinye Park' WHEN 3 THEN '***' WHEN 4 THEN NULL ELSE 'Metropol AVM #1' END AS shopping_mall
 FROM {lineitem}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # DataFrame arguments to spark.sql avoid registering global temp views.
    return spark.sql(BRONZE_CUSTOMERS_SQL, customer=table(spark, sf_dir, "customer"))


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_SALES_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def bronze_customers_sql() -> str:
    """The customers view as DuckDB text over the pre-registered tables."""
    return BRONZE_CUSTOMERS_SQL.replace("{customer}", "customer")


def bronze_sales_sql() -> str:
    return BRONZE_SALES_SQL.replace("{lineitem}", "lineitem")
