"""Rejects with reasons, valid rows first, counters that a rerun cannot spoil."""

import glob
import os
import shutil

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from argent.errors import ProcessingError
from argent.operators.stages import dedup
from argent.plans import rejects
from argent.plans.bronze import bronze_customers, bronze_sales
from argent.plans.pipelines import customer_pipeline, sales_pipeline
from argent.plans.quality import customer_quality, observed_sales_pipeline, sales_quality
from argent.plans.rejects import split_customers, split_sales
from argent.plans.staging import stage_parquet
from argent.sources import read_parquet, route_bad_records
from conftest import SF_SMALL
from test_plans import _exchanges, _plan


def _same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def _by_reason(rejects):
    return {r.reason: r["count"] for r in rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").count().collect()}


def _source(df, label):
    path = stage_parquet(df, label)
    return path, read_parquet(df.sparkSession, path)


@pytest.mark.parametrize("keep", ["first", "valid_first"])
def test_sales_split_agrees_with_pipeline_and_counters(spark, keep):
    path, bronze = _source(bronze_sales(spark, SF_SMALL), "t-rejects-sales")
    report = sales_quality(bronze, keep=keep).first().asDict()
    silver = sales_pipeline(bronze, keep=keep).collect()
    split = split_sales(bronze, keep=keep)
    shutil.rmtree(path.removeprefix("file:"))  # the source is not read again
    assert sorted(map(tuple, split.silver.collect()), key=repr) == sorted(map(tuple, silver), key=repr)
    want = {k: v for k, v in report.items() if not k.startswith("rows_")}
    assert _by_reason(split.rejects) == want
    assert split.rejects.columns == [*split.silver.columns, "reasons"]


def test_customer_split_agrees_with_pipeline_and_counters(spark):
    path, bronze = _source(bronze_customers(spark, SF_SMALL), "t-rejects-customers")
    report = customer_quality(bronze).first().asDict()
    silver = customer_pipeline(bronze).collect()
    split = split_customers(bronze)
    shutil.rmtree(path.removeprefix("file:"))
    assert sorted(map(tuple, split.silver.collect()), key=repr) == sorted(map(tuple, silver), key=repr)
    assert _by_reason(split.rejects) == {k: v for k, v in report.items() if not k.startswith("rows_")}


def test_split_of_a_hot_key_and_clashing_columns(spark):
    rows = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.lit("Male").alias("gender"), F.lit("30").alias("age"), F.lit("Cash").alias("payment_method"),
        F.lit(7).alias("reasons"), F.col("id").alias("__row"),
    )
    split = split_customers(rows)
    assert split.silver.count() == 20_001 and _by_reason(split.rejects) == {"duplicates_removed": 9_999}
    assert split_customers(rows.limit(0)).rejects.count() == 0
    with pytest.raises(ProcessingError, match="Missing columns"):
        split_customers(rows.drop("age"))


def test_rejects_cross_one_shuffle_as_they_came(spark):
    """No row is written or shuffled cleaned and as it came, none is joined back
    by row number, even where Spark broadcasts nothing on its own."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = split_sales(bronze_sales(spark, SF_SMALL)).rejects
        plan = _plan(found)
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert plan.count("REPARTITION_BY_COL") == 1 and "Window" in plan
        files = [f for f in found.inputFiles() if "/came-" in f]
        staged = spark.read.parquet(*files)
        assert staged.columns == [*found.columns[:-1], "__argent_row"] and {t for _, t in staged.dtypes[:-1]} == {"string"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("keep", ["first", "valid_first"])
def test_hot_keys_have_the_same_rejects(spark, keep, monkeypatch):
    """Keys above and below the bound: null, blank, one that many rows have, all
    with equal rows and with rows that differ only as they came."""
    i = F.col("id")
    df = spark.range(0, 1200, numPartitions=5).select(
        F.when(i % 4 == 0, F.lit(" hot")).when(i % 4 == 1, F.lit(None)).when(i % 12 == 2, F.lit(" ")).otherwise(F.concat(F.lit("I"), (i % 70).cast("string"))).alias("invoice_no"),
        F.when(i % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), (i % 3).cast("string"))).alias("customer_id"),
        F.when(i % 2 == 0, F.lit("Books")).otherwise(F.lit(" books ")).alias("category"),
        F.lit("1").alias("quantity"), F.when(i % 7 == 0, F.lit("-1")).otherwise(F.lit("2")).alias("price"),
        F.lit("01-01-2022").alias("invoice_date"), F.lit("Mall").alias("shopping_mall"),
    )
    plain, silver = split_sales(df, keep=keep).rejects, sales_pipeline(df, keep=keep)
    monkeypatch.setattr(rejects, "HOT_ROWS", 60)
    split = split_sales(df, keep=keep)
    report = sales_quality(df, keep=keep).first().asDict()
    assert report["duplicates_removed"] > 1000
    assert _by_reason(split.rejects) == {k: v for k, v in report.items() if v and not k.startswith("rows_")}
    assert _same(split.rejects, plain) and _same(split.silver, silver)
    tasks = split.rejects.filter(F.trim("invoice_no") == "hot").select(F.spark_partition_id()).distinct()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tasks.count() > 1  # a hot key is no task of its own
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_valid_rows_come_first(spark, ansi):
    rows = [("I1", "", "1"), ("I1", "C9", "2"), ("I1", "C8", "3"), ("I2", None, "4"), (None, "C1", "5")]
    df = spark.createDataFrame(
        [(i, c, "Books", "1", p, "01-01-2022", "Mall") for i, c, p in rows],
        "invoice_no string, customer_id string, category string, quantity string, price string, invoice_date string, shopping_mall string",
    )
    assert sales_pipeline(df).count() == 0
    assert [(r.invoice_no, r.customer_id) for r in sales_pipeline(df, keep="valid_first").collect()] == [("I1", "C8")]
    assert sales_quality(df, keep="valid_first").first().invalid_sales == 2
    with pytest.raises(ProcessingError, match="keep must be"):
        sales_pipeline(df, keep="last")
    by_window = dedup(df, ["invoice_no"], order_by=[F.col("price").desc()], valid=F.col("customer_id") != "")
    assert {r.invoice_no: r.price for r in by_window.collect()} == {"I1": "3", "I2": "4", None: "5"}


def test_valid_first_costs_no_more_exchanges(spark):
    bronze = bronze_sales(spark, SF_SMALL)
    plan = _plan(sales_pipeline(bronze, keep="valid_first"))
    assert _exchanges(plan) == ["Exchange hashpartitioning"] and "partial_min" in plan
    assert sales_pipeline(bronze, keep="valid_first").count() >= sales_pipeline(bronze).count()


def test_counters_are_exact_when_a_finished_stage_runs_again(spark):
    """Shuffle files are lost while the writing stage runs: the scan and the
    partial dedup run once more, and what they would have counted twice (the
    check below does) the report counts once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bronze = bronze_sales(spark, SF_SMALL)
        check = Observation()
        out, seen = observed_sales_pipeline(bronze.observe(check, F.count(F.lit(1)).alias("rows")))
        blocks = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

        def lose_shuffle_files(batches):
            for d in blocks:
                for f in glob.glob(os.path.join(d, "*", "shuffle_*.data")):
                    if not os.path.exists(os.path.join(d, "lost")):
                        os.remove(f)
                with open(os.path.join(d, "lost"), "w"):
                    pass
            yield from batches

        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "60")  # more tasks than cores, so that some read later
        try:
            out.mapInArrow(lose_shuffle_files, out.schema).write.format("noop").mode("overwrite").save()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    report = sales_quality(bronze_sales(spark, SF_SMALL)).first().asDict()
    assert check.get["rows"] > report["rows_in"]  # the stage did run again
    assert seen.report() == report


def test_observed_counters_with_valid_first(spark):
    out, seen = observed_sales_pipeline(bronze_sales(spark, SF_SMALL), keep="valid_first")
    out.write.format("noop").mode("overwrite").save()
    assert seen.report() == sales_quality(bronze_sales(spark, SF_SMALL), keep="valid_first").first().asDict()
    assert _same(out, sales_pipeline(bronze_sales(spark, SF_SMALL), keep="valid_first"))


def test_bad_records_are_written_aside(spark, workdir):
    lines = ["1,one,10", "2,two", "x,three,30", "4,four,40,more", "5,,", "", "6,six,60"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{workdir}/in")
    good = route_bad_records(spark, f"{workdir}/in", "id int, name string, size int", f"{workdir}/bad", header=False)
    assert sorted(map(tuple, good.collect()), key=repr) == [(1, "one", 10), (5, None, None), (6, "six", 60)]
    assert good.select("name").count() == 3 and good.select("id").distinct().count() == 3  # whatever is read
    bad = spark.read.parquet(f"{workdir}/bad")
    assert sorted(r.line for r in bad.collect()) == ["2,two", "4,four,40,more", "x,three,30"]
    assert {r.file_name for r in bad.collect()} <= set(os.listdir(f"{workdir}/in".removeprefix("file:")))
    assert {r.line: r.parsed.name for r in bad.collect()}["x,three,30"] == "three"
    route_bad_records(spark, f"{workdir}/in", "id int, name string, size int", f"{workdir}/bad", header=False)
    assert spark.read.parquet(f"{workdir}/bad").count() == 6  # appended
