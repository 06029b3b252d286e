"""Every registered query: (spark, sf_dir) -> DataFrame, plus its oracle.

Inputs are the driver tables or bronze views Spark derives from them over
every row; file-scan and sink queries first stage such data in the shared
folder (``spark.checkpoint.dir``), then scan or read it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.functions.exprs import INVOICE_DATE_FORMAT
from argent.operators import customers as cust
from argent.operators import sales as sal
from argent.operators.stages import conform, dedup, fill_missing, trim_strings
from argent.plans import oracle
from argent.plans.bronze import bronze_customers, bronze_sales, table
from argent.plans.job import bronze_to_silver
from argent.plans.pipelines import customer_pipeline, sales_pipeline
from argent.plans.quality import customer_quality, observed_sales_pipeline, sales_quality
from argent.plans.rejects import Split, split_customers, split_sales
from argent.plans.staging import stage_csv, stage_parquet, stage_text
from argent.schemas import KEY, NUMBER, CustomerColumns, SalesColumns
from argent.session import scratch_path, shared_dir
from argent.sinks.writers import write_keyed_table, write_path, write_table
from argent.sources.scans import read_csv, read_csv_validated, read_parquet, read_parquet_validated, route_bad_records

CC, SC = CustomerColumns(), SalesColumns()
Query = Callable[[SparkSession, str], DataFrame]


# --- helpers ---------------------------------------------------------------

def _conformed_customers(s: SparkSession, d: str) -> DataFrame:
    return conform(bronze_customers(s, d), CC.schema())


def _conformed_sales(s: SparkSession, d: str, fmt: str | None = INVOICE_DATE_FORMAT) -> DataFrame:
    return conform(bronze_sales(s, d), SC.schema(), date_format=fmt)


def _silver_customers(s: SparkSession, d: str) -> DataFrame:
    return customer_pipeline(bronze_customers(s, d))


def _silver_sales(s: SparkSession, d: str) -> DataFrame:
    return sales_pipeline(bronze_sales(s, d))


# --- sources ---------------------------------------------------------------

def q_csv_scan_strings(s: SparkSession, d: str) -> DataFrame:
    path = stage_csv(bronze_sales(s, d), "bronze-sales-csv")
    return read_csv(s, path, header=True, infer_schema=False)


def q_csv_scan_delimited(s: SparkSession, d: str) -> DataFrame:
    path = stage_csv(bronze_customers(s, d), "bronze-customers-psv", sep="|")
    return read_csv(s, path, header=True, infer_schema=False, delimiter="|")


def q_csv_scan_no_header(s: SparkSession, d: str) -> DataFrame:
    path = stage_csv(bronze_sales(s, d), "bronze-sales-noheader", header=False)
    return read_csv(s, path, header=False, infer_schema=False)


def q_csv_scan_inferred(s: SparkSession, d: str) -> DataFrame:
    path = stage_csv(table(s, d, "part"), "part-csv")
    return read_csv(s, path, header=True, infer_schema=True)


PART_SCHEMA = (
    "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
    "p_size INT, p_retailprice DOUBLE"
)


def q_csv_scan_schema(s: SparkSession, d: str) -> DataFrame:
    path = stage_csv(table(s, d, "part"), "part-csv")
    return read_csv(s, path, header=True, schema=PART_SCHEMA)


def q_csv_scan_quoted(s: SparkSession, d: str) -> DataFrame:
    quoted = table(s, d, "part").select(
        F.col("p_name").alias("name"),
        F.concat(F.col("p_brand"), F.lit(', "'), F.col("p_type"), F.lit('"')).alias("description"),
        F.concat(F.lit("size "), F.col("p_size").cast("string"), F.lit(', "boxed"')).alias("notes"),
    )
    # Embedded quotes are written doubled ("" inside a quoted field).
    opts = {"quote": '"', "escape": '"'}
    path = stage_csv(quoted, "quoted-csv", options=opts)
    return read_csv(s, path, header=True, infer_schema=False, options=opts)


PERMISSIVE_SCHEMA = "id BIGINT, name STRING, size INT, _corrupt_record STRING"


def q_csv_scan_permissive(s: SparkSession, d: str) -> DataFrame:
    k, name, size = F.col("p_partkey"), F.col("p_name"), F.col("p_size").cast("string")
    key = k.cast("string")
    line = (
        F.when(k % 10 == 0, F.concat_ws(",", key, name))  # too few fields
        .when(k % 10 == 1, F.concat_ws(",", key, name, size, F.lit("extra")))  # too many
        .otherwise(F.concat_ws(",", key, name, size))
    )
    path = stage_text(table(s, d, "part").select(line.alias("value")), "malformed-csv")
    return read_csv(s, path, header=False, schema=PERMISSIVE_SCHEMA)


ROUTED_SCHEMA = "id BIGINT, name STRING, size INT"


def _routed(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad records) of two feeds with malformed lines in both."""
    k, name, size = F.col("p_partkey"), F.col("p_name"), F.col("p_size").cast("string")
    key = k.cast("string")
    line = (
        F.when(k % 10 == 0, F.concat_ws(",", key, name))  # too few fields
        .when(k % 10 == 1, F.concat_ws(",", key, name, size, F.lit("extra")))  # too many
        .when(k % 10 == 2, F.concat_ws(",", key, name, F.lit("big")))  # no number
        .otherwise(F.concat_ws(",", key, name, size))
    )
    root = scratch_path(s, "feeds")
    table(s, d, "part").select(line.alias("value"), (k % 2).alias("feed")).write.partitionBy("feed").text(root)
    bad = scratch_path(s, "bad-records")
    good = route_bad_records(s, root, ROUTED_SCHEMA, bad, header=False, options={"recursiveFileLookup": "true"})
    return good, s.read.parquet(bad)


def q_csv_good_records(s: SparkSession, d: str) -> DataFrame:
    return _routed(s, d)[0]


def q_csv_bad_records(s: SparkSession, d: str) -> DataFrame:
    feed = F.regexp_extract("file_path", r"/feed=(\d+)/", 1)
    return _routed(s, d)[1].select(feed.alias("feed"), F.col("file_name").startswith("part-").alias("named"), "line", "parsed.id")


def q_parquet_scan(s: SparkSession, d: str) -> DataFrame:
    return read_parquet(s, f"{d}/orders.parquet")


def q_parquet_scan_schema(s: SparkSession, d: str) -> DataFrame:
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_comment STRING"
    return read_parquet(s, f"{d}/orders.parquet", schema=schema)


def q_parquet_scan_merge_schema(s: SparkSession, d: str) -> DataFrame:
    orders = table(s, d, "orders")
    root = scratch_path(s, "orders-two-dirs")
    half = ["o_custkey", "o_orderstatus"]
    stage_parquet(orders.select("o_orderkey", *half), "a", f"{root}/a")
    stage_parquet(orders.drop(*half), "b", f"{root}/b/nested")
    return read_parquet(
        s, root, options={"mergeSchema": "true", "recursiveFileLookup": "true"}
    )


def q_nested_scan(s: SparkSession, d: str) -> DataFrame:
    e = read_parquet(s, f"{d}/embeddings.parquet")
    return e.select(
        "vec_id",
        "label",
        F.size("embedding").alias("dims"),
        F.try_element_at("embedding", F.lit(1)).alias("first_value"),
        F.try_element_at("embedding", F.lit(-1)).alias("last_value"),
    )


def q_nested_map_scan(s: SparkSession, d: str) -> DataFrame:
    # A map column written to Parquet and read back by key.
    orders = table(s, d, "orders").select(
        "o_orderkey",
        F.create_map(
            F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority")
        ).alias("metadata"),
    )
    path = stage_parquet(orders, "orders-map")
    back = read_parquet(s, path)
    return back.select(
        "o_orderkey",
        F.col("metadata").getItem("status").alias("status"),
        F.col("metadata").getItem("priority").alias("priority"),
        F.size("metadata").alias("n_keys"),
    )


TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def q_timestamp_parse(s: SparkSession, d: str) -> DataFrame:
    ev = read_parquet(s, f"{d}/events.parquet").withColumn("ts_text", F.date_format("ts", TS_FORMAT))
    # Wall-clock parse (no session time zone involved), like the input column.
    return ev.withColumn("parsed", F.to_timestamp_ntz("ts_text", F.lit(TS_FORMAT)))


def q_validated_scan(s: SparkSession, d: str) -> DataFrame:
    return read_parquet_validated(
        s, f"{d}/customer.parquet", expected_columns=["c_custkey", "c_name", "c_acctbal"], min_rows=1
    )


def q_csv_validated_scan(s: SparkSession, d: str) -> DataFrame:
    customers = table(s, d, "customer")
    path = stage_csv(customers, "customer-csv")
    return read_csv_validated(s, path, ["c_custkey", "c_name", "c_acctbal"], min_rows=100, schema=customers.schema)


# --- sinks -----------------------------------------------------------------

def q_sink_path(s: SparkSession, d: str) -> DataFrame:
    dest = scratch_path(s, "silver-sales")
    write_path(_silver_sales(s, d), dest, options={"compression": "gzip"})
    return s.read.parquet(dest)


def q_sink_append(s: SparkSession, d: str) -> DataFrame:
    dest = scratch_path(s, "silver-customers-append")
    silver = _silver_customers(s, d)
    write_path(silver, dest, mode="overwrite")
    write_path(silver, dest, mode="append")
    return s.read.parquet(dest)


def q_sink_ignore(s: SparkSession, d: str) -> DataFrame:
    dest = scratch_path(s, "silver-customers-ignore")
    silver = _silver_customers(s, d)
    write_path(silver, dest, mode="errorifexists")
    write_path(silver, dest, mode="ignore")
    return s.read.parquet(dest)


def q_sink_partition_overwrite(s: SparkSession, d: str) -> DataFrame:
    """Sales by category; then two of the categories once more, at twice the
    price, over their own partitions only."""
    dest = scratch_path(s, "silver-sales-by-category")
    silver = _silver_sales(s, d)
    write_path(silver, dest, partition_by=[SC.category])
    doubled = silver.filter(F.col(SC.category).isin("BOOKS", "SHOES")).withColumn(SC.price, F.col(SC.price) * 2)
    write_path(doubled, dest, partition_by=[SC.category], options={"partitionOverwriteMode": "dynamic"})
    return s.read.parquet(dest).select(*silver.columns)


SILVER_DATABASE = "argent_silver"


def _silver_name(s: SparkSession, label: str) -> str:
    location = f"{shared_dir(s)}/argent/warehouse/{SILVER_DATABASE}.db"
    s.sql(f"CREATE DATABASE IF NOT EXISTS {SILVER_DATABASE} LOCATION '{location}'")
    return f"{label}_{uuid.uuid4().hex[:12]}"


def q_sink_table(s: SparkSession, d: str) -> DataFrame:
    full = write_table(_silver_customers(s, d), _silver_name(s, "customers"), SILVER_DATABASE)
    return s.table(full)


def q_sink_keyed_table(s: SparkSession, d: str) -> DataFrame:
    """Two deliveries of sales, dealt out by invoice as they are written, and
    merged without a shuffle."""
    sales, name = trim_strings(bronze_sales(s, d)), _silver_name(s, "sales")
    late = F.col(SC.shopping_mall).isNull()
    write_keyed_table(sales.filter(~late), name, SC.having(KEY), SILVER_DATABASE)
    full = write_keyed_table(sales.filter(late), name, SC.having(KEY), SILVER_DATABASE, mode="append")
    return dedup(s.table(full), SC.having(KEY))


def _with_reasons(split: Split) -> DataFrame:
    return split.rejects.withColumn("reasons", F.array_join("reasons", ","))


def q_bronze_to_silver(s: SparkSession, d: str) -> DataFrame:
    customer_src = stage_parquet(bronze_customers(s, d), "bronze-customers-parquet")
    sales_src = stage_csv(bronze_sales(s, d), "bronze-sales-csv")
    done = bronze_to_silver(s, customer_src, sales_src, scratch_path(s, "silver"))
    customers, sales = s.read.parquet(done.customers), s.read.parquet(done.sales)
    return customers.withColumn("silver_table", F.lit("customers")).unionByName(
        sales.withColumn("silver_table", F.lit("sales")), allowMissingColumns=True
    )


def q_job_counters(s: SparkSession, d: str) -> DataFrame:
    """The counters that the whole job gathers while it writes."""
    customer_src = stage_parquet(bronze_customers(s, d), "bronze-customers-parquet")
    sales_src = stage_csv(bronze_sales(s, d), "bronze-sales-csv")
    done = bronze_to_silver(s, customer_src, sales_src, scratch_path(s, "silver"))
    rows = [("customers", k, v) for k, v in done.customer_quality.items()]
    rows += [("sales", k, v) for k, v in done.sales_quality.items()]
    return s.createDataFrame(rows, "silver_table string, counter string, value bigint")


# --- registry --------------------------------------------------------------

QUERIES: dict[str, Query] = {
    # pipelines and quality reports
    "customer_pipeline": _silver_customers,
    "sales_pipeline": _silver_sales,
    "sales_pipeline_observed": lambda s, d: observed_sales_pipeline(bronze_sales(s, d))[0],
    "customer_quality": lambda s, d: customer_quality(bronze_customers(s, d)),
    "sales_quality": lambda s, d: sales_quality(bronze_sales(s, d)),
    "sales_pipeline_valid_first": lambda s, d: sales_pipeline(bronze_sales(s, d), keep="valid_first"),
    "sales_quality_valid_first": lambda s, d: sales_quality(bronze_sales(s, d), keep="valid_first"),
    "customer_rejects": lambda s, d: _with_reasons(split_customers(bronze_customers(s, d))),
    "sales_rejects": lambda s, d: _with_reasons(split_sales(bronze_sales(s, d))),
    "sales_split_silver": lambda s, d: split_sales(bronze_sales(s, d)).silver,
    # shared stages
    "conform_customer": _conformed_customers,
    "conform_sales": _conformed_sales,
    "trim_strings": lambda s, d: trim_strings(bronze_sales(s, d)),
    "fill_missing_strings": lambda s, d: fill_missing(
        bronze_sales(s, d), string_columns=[SC.category, SC.shopping_mall]
    ),
    "fill_missing_numerics": lambda s, d: fill_missing(
        _conformed_sales(s, d), numeric_columns=SC.having(NUMBER), default_numeric=0.0
    ),
    "dedup_by_key": lambda s, d: dedup(trim_strings(bronze_sales(s, d)), SC.having(KEY)),
    "dedup_rows": lambda s, d: dedup(trim_strings(bronze_sales(s, d))),
    # customer rules
    "customer_gender": lambda s, d: cust.clean_gender(_conformed_customers(s, d), CC.gender),
    "customer_age": lambda s, d: cust.validate_age(_conformed_customers(s, d), CC.age),
    "customer_names": lambda s, d: cust.clean_names(
        table(s, d, "customer"), ["c_name"]
    ),
    "customer_validate": lambda s, d: cust.validate_customers(
        _conformed_customers(s, d), CC.customer_id
    ),
    # sales rules
    "sales_invoice_date": lambda s, d: sal.parse_invoice_date(bronze_sales(s, d), SC.invoice_date),
    "sales_invoice_date_cast_first": lambda s, d: sal.parse_invoice_date(
        _conformed_sales(s, d, fmt=None), SC.invoice_date
    ),
    "sales_numeric_fields": lambda s, d: sal.validate_numeric_fields(_conformed_sales(s, d), SC),
    "sales_category": lambda s, d: sal.clean_category(bronze_sales(s, d), SC.category),
    "sales_mall_names": lambda s, d: sal.clean_mall_names(bronze_sales(s, d), SC.shopping_mall),
    "sales_validate": lambda s, d: sal.validate_sales(_conformed_sales(s, d), SC),
    # sources
    "csv_scan_strings": q_csv_scan_strings,
    "csv_scan_inferred": q_csv_scan_inferred,
    "csv_scan_schema": q_csv_scan_schema,
    "csv_scan_delimited": q_csv_scan_delimited,
    "csv_scan_quoted": q_csv_scan_quoted,
    "csv_scan_permissive": q_csv_scan_permissive,
    "csv_scan_no_header": q_csv_scan_no_header,
    "csv_good_records": q_csv_good_records,
    "csv_bad_records": q_csv_bad_records,
    "parquet_scan": q_parquet_scan,
    "parquet_scan_schema": q_parquet_scan_schema,
    "parquet_scan_merge_schema": q_parquet_scan_merge_schema,
    "nested_scan": q_nested_scan,
    "nested_map_scan": q_nested_map_scan,
    "timestamp_parse": q_timestamp_parse,
    "validated_scan": q_validated_scan,
    "csv_validated_scan": q_csv_validated_scan,
    # sinks and the whole job
    "sink_path": q_sink_path,
    "sink_append": q_sink_append,
    "sink_ignore": q_sink_ignore,
    "sink_partition_overwrite": q_sink_partition_overwrite,
    "sink_table": q_sink_table,
    "sink_keyed_table": q_sink_keyed_table,
    "bronze_to_silver": q_bronze_to_silver,
    "bronze_to_silver_counters": q_job_counters,
    # test-surface operations
    "agg_total_quantity": lambda s, d: table(s, d, "lineitem").agg(
        F.sum("l_quantity").alias("total_quantity")
    ),
    "filter_product": lambda s, d: table(s, d, "lineitem").filter(
        (F.col("l_returnflag") == "R") & F.col("l_linestatus").isin("O", "F")
    ),
}

ORACLES: dict[str, Callable[[], str]] = {k: getattr(oracle, k) for k in QUERIES}
