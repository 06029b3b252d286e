"""Path and table sinks: modes, guards, error wrapping."""

import os

import pytest
from pyspark.sql import functions as F

from argent.errors import LoadingError
from argent.sinks import write_path, write_table


def _people(spark):
    return spark.createDataFrame([("A", 1, "X"), ("B", 2, "Y"), ("C", 3, "Z")], "name string, age long, city string")


def test_write_and_read_back(spark, workdir):
    write_path(_people(spark), f"{workdir}/out")
    assert spark.read.parquet(f"{workdir}/out").count() == 3


def test_overwrite_then_append(spark, workdir):
    p = f"{workdir}/out"
    write_path(_people(spark), p)
    write_path(_people(spark), p, mode="overwrite")
    assert spark.read.parquet(p).count() == 3
    write_path(_people(spark), p, mode="append")
    assert spark.read.parquet(p).count() == 6


def test_ignore_and_errorifexists(spark, workdir):
    p = f"{workdir}/out"
    write_path(_people(spark), p)
    write_path(_people(spark).union(_people(spark)), p, mode="ignore")
    assert spark.read.parquet(p).count() == 3
    with pytest.raises(LoadingError, match="Failed to load data"):
        write_path(_people(spark), p, mode="errorifexists")


def test_empty_is_refused(spark, workdir):
    with pytest.raises(LoadingError, match="Cannot load empty DataFrame"):
        write_path(_people(spark).filter("age > 10"), f"{workdir}/out")
    with pytest.raises(LoadingError, match="Cannot load empty DataFrame as table"):
        write_table(spark.createDataFrame([], "a int"), "t_empty")


def test_empty_after_shuffle_refused_and_destination_kept(spark, workdir):
    p = f"{workdir}/out"
    write_path(_people(spark), p)
    nothing = _people(spark).groupBy("city").agg(F.count("*").alias("n")).filter("n > 5")
    with pytest.raises(LoadingError, match="empty"):
        write_path(nothing, p)
    assert spark.read.parquet(p).count() == 3


def test_bad_mode_and_unwritable_path(spark, workdir):
    with pytest.raises(LoadingError):
        write_path(_people(spark), f"{workdir}/out", mode="sideways")
    with pytest.raises(LoadingError, match="Failed to load data to /proc/nope/x"):
        write_path(_people(spark), "/proc/nope/x")


@pytest.mark.parametrize("spelling", ["plain", "uri", "relative", "symlink"])
def test_overwriting_ones_own_input(spark, workdir, spelling, monkeypatch):
    real = workdir.removeprefix("file:") + "/a folder (1)/out"
    write_path(_people(spark), real)
    given = real
    if spelling == "uri":
        given = "file:" + real
    elif spelling == "relative":  # as Hadoop sees it, from the JVM's folder
        given = os.path.relpath(real, spark._jvm.java.lang.System.getProperty("user.dir"))
    elif spelling == "symlink":
        given = real + "-link"
        os.symlink(real, given)
    write_path(spark.read.parquet(real).filter("age > 1"), given)
    assert sorted(r.age for r in spark.read.parquet(given).collect()) == [2, 3]
    assert spark.read.parquet(real).count() in (2, 3)  # readable under its own name, too
    with pytest.raises(LoadingError, match="empty"):
        write_path(spark.read.parquet(real).filter("age > 9"), given)
    assert spark.read.parquet(given).count() == 2
    assert [f for f in os.listdir(os.path.dirname(real)) if f.startswith(".out")] == []


def test_failed_write_leaves_the_destination(spark, workdir):
    p = f"{workdir}/out"
    write_path(_people(spark), p)
    bad = _people(spark).withColumn("x", F.raise_error(F.lit("no")))
    with pytest.raises(LoadingError, match="Failed to load data"):
        write_path(bad, p)
    assert spark.read.parquet(p).count() == 3


def test_a_callers_cache_is_left_alone(spark, workdir):
    df = _people(spark).groupBy("city").count().persist()
    write_path(df, f"{workdir}/out")
    assert df.storageLevel.useMemory
    df.unpersist()


def test_one_action_per_write(spark, workdir):
    sc = spark.sparkContext
    sc.setJobGroup("t-one", "one")
    assert write_path(_people(spark).repartition(3), f"{workdir}/out")
    assert len(sc.statusTracker().getJobIdsForGroup("t-one")) <= 2  # the shuffle stage and the write
    sc.setJobGroup("t-idle", "idle")


def test_append_with_other_schema_refused(spark, workdir):
    p = f"{workdir}/out"
    write_path(_people(spark), p)
    other = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(LoadingError, match="Cannot append"):
        write_path(other, p, mode="append")


def test_options_pass_through(spark, workdir):
    for codec, ending in (("gzip", ".gz.parquet"), ("snappy", ".snappy.parquet")):
        write_path(_people(spark), f"{workdir}/{codec}", options={"compression": codec})
        names = os.listdir(f"{workdir}/{codec}".removeprefix("file:"))
        assert [n for n in names if n.startswith("part-")] and all(n.endswith(ending) for n in names if n.startswith("part-"))


def test_table_overwrite_reads_itself_and_refuses_empty(spark, workdir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS argent_swap_db LOCATION '{workdir}/swap'")
    full = write_table(_people(spark), "people", database="argent_swap_db")
    write_table(spark.table(full).filter("age > 1"), "people", database="argent_swap_db")
    assert spark.table(full).count() == 2
    with pytest.raises(LoadingError, match="empty"):
        write_table(spark.table(full).filter("age > 9"), "people", database="argent_swap_db")
    write_table(_people(spark), "people", database="argent_swap_db", mode="append")
    assert spark.table(full).count() == 5
    assert [t.name for t in spark.catalog.listTables("argent_swap_db")] == ["people"]
    spark.sql(f"DROP TABLE {full}")


def test_table_sink(spark, workdir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS argent_test_db LOCATION '{workdir}/wh'")
    full = write_table(_people(spark), "people", database="argent_test_db")
    assert full == "argent_test_db.people"
    assert spark.table(full).count() == 3
    with pytest.raises(LoadingError, match="Failed to load data as table no_such_db.people"):
        write_table(_people(spark), "people", database="no_such_db")
    spark.sql("DROP TABLE argent_test_db.people")


def test_noop_sink_needs_no_path(spark):
    write_path(_people(spark), None, fmt="noop")


def test_batch_ignores_streaming_only_options(spark, workdir):
    # The source project's test passed a checkpointLocation to a batch write.
    write_path(_people(spark), f"{workdir}/out", options={"checkpointLocation": f"{workdir}/cp"})
    assert spark.read.parquet(f"{workdir}/out").count() == 3


def test_ignore_on_existing_path_does_not_compute(spark, workdir):
    p = f"{workdir}/out"
    write_path(_people(spark), p)
    sc = spark.sparkContext
    sc.setJobGroup("t-ignore", "ignore")
    write_path(_people(spark).groupBy("city").count(), p, mode="ignore")
    assert sc.statusTracker().getJobIdsForGroup("t-ignore") == []
    sc.setJobGroup("t-idle", "idle")
    assert spark.read.parquet(p).columns == ["name", "age", "city"]


def test_unknown_format_fails_before_any_work(spark, workdir):
    sc = spark.sparkContext
    sc.setJobGroup("t-format", "format")
    with pytest.raises(LoadingError, match="not available"):
        write_path(_people(spark).groupBy("city").count(), f"{workdir}/out", fmt="no_such_format")
    with pytest.raises(LoadingError, match="not available"):
        write_table(_people(spark), "t_fmt", fmt="no_such_format")
    assert sc.statusTracker().getJobIdsForGroup("t-format") == []
    sc.setJobGroup("t-idle", "idle")


def test_partitioned_write(spark, workdir):
    p = f"{workdir}/by_city"
    write_path(_people(spark), p, partition_by=["city"])
    back = spark.read.parquet(p)
    assert back.count() == 3
    assert sorted(r.city for r in back.select("city").distinct().collect()) == ["X", "Y", "Z"]
    # Partition pruning: a filter on the partition column reads one folder.
    plan = back.filter("city = 'X'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan
