"""Physical-plan checks: one shuffle per pipeline, partial dedup before it,
pruned scans, no Python evaluation."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import argent
from argent.errors import ProcessingError
from argent.operators.stages import dedup, trim_strings
from argent.plans.bronze import bronze_sales
from argent.plans.pipelines import sales_pipeline
from argent.plans.registry import QUERIES
from argent.sources.scans import read_parquet
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _bronze_sales_file(spark, workdir):
    p = f"{workdir}/bronze_sales"
    spark.createDataFrame(
        [(" I1 ", "C1", "Books", "2", "10.0", "01-01-2022", "Mall", "junk")] * 3,
        "invoice_no string, customer_id string, category string, quantity string, "
        "price string, invoice_date string, shopping_mall string, extra string",
    ).write.parquet(p)
    return p


def _exchanges(plan: str) -> list[str]:
    return re.findall(r"(?<!Broadcast)Exchange \w+", plan)


def test_registered_pipelines_have_one_exchange(spark):
    for key in ("sales_pipeline", "sales_pipeline_valid_first", "customer_pipeline", "sales_pipeline_observed", "dedup_by_key"):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        assert _exchanges(plan) == ["Exchange hashpartitioning"], key
        assert "partial_min" in plan
    assert _exchanges(_plan(QUERIES["sink_keyed_table"](spark, SF_SMALL))) == []  # dealt out when it was written
    assert _exchanges(_plan(QUERIES["agg_total_quantity"](spark, SF_SMALL))) == ["Exchange SinglePartition"]
    for key in ("sales_quality", "customer_quality"):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        # The key shuffle, after partial counts, and the one-row gather.
        assert sorted(_exchanges(plan)) == ["Exchange SinglePartition", "Exchange hashpartitioning"], key
        assert "SortAggregate" not in plan and "partial_count" in plan


def test_sales_pipeline_prunes_and_stays_in_the_jvm(spark, workdir):
    plan = _plan(sales_pipeline(read_parquet(spark, _bronze_sales_file(spark, workdir))))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "invoice_no" in scan and "extra" not in scan


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").filter(
        (F.col("l_returnflag") == "R") & F.col("l_linestatus").isin("O", "F")).select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_linestatus:string>" in plan


def test_dedup_equals_a_window_over_the_same_order(spark):
    bronze = trim_strings(bronze_sales(spark, SF_SMALL))
    rest = [F.col(c).asc_nulls_first() for c in bronze.columns if c != "invoice_no"]
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(dedup(bronze, ["invoice_no"])) == rows(dedup(bronze, ["invoice_no"], order_by=rest))


def test_dedup_orders_maps_and_refuses_what_has_no_order(spark):
    df = spark.createDataFrame([(1, {"b": 1, "a": 2}), (1, {"a": 1}), (2, None), (2, {"z": 0})], "k int, m map<string,int>")
    for order in (df, df.repartition(4), df.orderBy(F.desc("k"))):
        assert {r.k: r.m for r in dedup(order, ["k"]).collect()} == {1: {"a": 1}, 2: None}
    nested = spark.createDataFrame([(1, [{"a": 1}])], "k int, m array<map<string,int>>")
    with pytest.raises(ProcessingError, match="cannot be ordered"):
        dedup(nested, ["k"])


def test_no_size_switch_in_the_package():
    for path in Path(argent.__file__).parent.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"sizeInBytes|_TAKE_LIMIT|MAX_BYTES|\.persist\(|inputFiles", path.read_text()), path
