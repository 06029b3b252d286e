"""Path and catalog-table sinks.

The format is an argument (default Parquet; ``delta`` works where its jar is
installed). A write never touches what is there until the new data stands
complete: it goes to a fresh sibling folder (or table) while the rows are
counted, an empty result is refused, and only then the data is moved into
place, by ``argent.sinks.commit``. So an append that turns out empty adds nothing,
the frame may read from its own destination, under whatever spelling of the
path, nothing is cached or computed twice, and a writer that is lost between two
moves leaves a commit that the next write or scan finishes.

Moves need a filesystem whose rename is cheap, such as HDFS. On an object store,
where a rename copies, write to a table format instead: formats that Spark does
not write as plain files are left to their own transactions, with one extra
``isEmpty`` before the write.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from argent.errors import LoadingError
from argent.operators.stages import dedup
from argent.sinks.commit import ADD, PARTITIONS, REPLACE, Folder

_PATHLESS_FORMATS = {"noop", "console", "memory"}
_FILE_FORMATS = {"parquet", "orc", "csv", "json", "text", "avro"}
_WITH_SCHEMA = {"parquet", "orc", "avro"}
_PARTITION_MODE = "partitionOverwriteMode"
_COMPLETE = "argent.complete"  # on a new table whose rows all stand
_MODES = {"overwrite", "append", "ignore", "error", "errorifexists", "default"}


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _check_append_schema(df: DataFrame, fmt: str, destination: str, partition_by: list[str]) -> None:
    """Refuse columns other than those that are there (plain Parquet would
    accept them silently). Partition columns live in folder names and have no
    type of their own."""
    try:
        existing = df.sparkSession.read.format(fmt).load(destination).schema
    except AnalysisException:
        return  # nothing there yet
    there, new = ([(f.name, f.dataType) for f in x.fields if f.name not in partition_by] for x in (existing, df.schema))
    if fmt in _WITH_SCHEMA and there != new:
        raise LoadingError(
            f"Cannot append to {destination}: schema {df.schema.simpleString()} "
            f"differs from existing {existing.simpleString()}"
        )


def _check_layout(folder: Folder, partition_by: list[str]) -> None:
    there = folder.partition_columns()
    if there != partition_by:
        raise LoadingError(f"{folder.at} is laid out by {there or 'no columns'}, not by {partition_by or 'no columns'}")


def _check_format(df: DataFrame, fmt: str) -> None:
    """Fail before any work when the sink format cannot be resolved (for
    example ``delta`` without its jar), instead of after the whole plan ran."""
    if fmt in _PATHLESS_FORMATS:
        return
    spark = df.sparkSession
    conf = spark._jsparkSession.sessionState().conf()  # noqa: SLF001
    try:
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(fmt, conf)  # noqa: SLF001
    except (Py4JJavaError, AnalysisException) as e:
        raise LoadingError(f"Sink format {fmt!r} is not available: {e}") from e


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _writer(
    df: DataFrame, fmt: str, mode: str, options: Mapping[str, Any] | None, partition_by: list[str] | None = None
) -> DataFrameWriter:
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    return writer.partitionBy(*partition_by) if partition_by else writer


def _by_partition(df: DataFrame, options: dict[str, Any], partition_by: list[str]) -> bool:
    """Whether an overwrite is to replace only the partitions that the new data
    holds: the writer's option, else the session's setting, as in Spark.
    Takes the option out, as the write goes to a fresh folder."""
    given = [options.pop(k) for k in list(options) if k.lower() == _PARTITION_MODE.lower()]
    mode = given[-1] if given else df.sparkSession.conf.get(f"spark.sql.sources.{_PARTITION_MODE}", "static")
    return bool(partition_by) and str(mode).lower() == "dynamic"


@contextmanager
def _reported(what: str) -> Iterator[None]:
    try:
        yield
    except LoadingError:
        raise
    except Exception as e:
        raise LoadingError(f"Failed to load data {what}: {e}") from e


def _mode(mode: str) -> str:
    m = mode.lower()
    if m not in _MODES:
        raise LoadingError(f"Unknown write mode {mode!r}")
    return "errorifexists" if m in ("error", "default") else m


def write_path(
    df: DataFrame,
    destination: str | None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: Mapping[str, Any] | None = None,
    partition_by: list[str] | None = None,
    guard_empty: bool = True,
) -> bool:
    """``df`` to a path, as the module says; whether anything was written. ``fmt="noop"`` runs the plan
    without output. Modes ``ignore`` and ``errorifexists`` compute nothing when
    the destination exists. An overwrite replaces the folder, or with
    ``partition_by`` and ``partitionOverwriteMode`` "dynamic" (as an option or of
    the session) only the partitions that ``df`` holds. An append to another
    schema or layout is refused, and so is an empty result, before anything
    changes."""
    target = destination or ""
    empty = f"Cannot load empty DataFrame to {target}"
    by, extra = list(partition_by or []), dict(options or {})
    with _reported(f"to {target}"):
        m = _mode(mode)
        if fmt not in _PATHLESS_FORMATS and not destination:
            raise LoadingError("A destination path is required")
        _check_format(df, fmt)
        if fmt not in _FILE_FORMATS:
            if guard_empty and df.isEmpty():
                raise LoadingError(empty)
            writer = _writer(df, fmt, m, extra, by)
            writer.save(destination) if destination else writer.save()
            return True
        folder = Folder(df.sparkSession, destination)
        folder.recover()
        there = folder.exists()
        if there and m == "ignore":
            return False
        if there and m == "errorifexists":
            raise LoadingError(f"Failed to load data to {destination}: it already exists")
        kind = {"append": ADD}.get(m, REPLACE)
        if _by_partition(df, extra, by) and m == "overwrite":
            kind = PARTITIONS
        if there and kind != REPLACE:
            _check_append_schema(df, fmt, destination, by)
            _check_layout(folder, by)
        counted, seen = _counted(df)
        new = folder.sibling("new")
        try:
            _writer(counted, fmt, "errorifexists", extra, by).save(new.toString())
            if guard_empty and not seen.get.get("rows"):
                raise LoadingError(empty)
        except Exception:
            folder.fs.delete(new, True)
            raise
        folder.commit(new, kind, len(by))
        return True


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _recover_tables(spark: SparkSession, database: list[str], name: str) -> None:
    """Finish the swap of a writer that was lost between two renames: a new
    table that its writer declared complete takes the name."""
    here = _quoted(*database, name)
    inside = f" IN {_quoted(*database)}" if database else ""
    names = sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES{inside} LIKE '{name}__*'").collect())
    olds = [n for n in names if n.startswith(f"{name}__old_")]
    for new in (n for n in names if n.startswith(f"{name}__new_")):
        made = spark.sql(f"SHOW TBLPROPERTIES {_quoted(*database, new)}").collect()
        if _COMPLETE not in {r["key"] for r in made}:
            continue  # unfinished, and perhaps somebody's
        if spark.catalog.tableExists(here):
            olds.append(new.replace("__new_", "__old_"))
            spark.sql(f"ALTER TABLE {here} RENAME TO {_quoted(*database, olds[-1])}")
        spark.sql(f"ALTER TABLE {_quoted(*database, new)} RENAME TO {here}")
        spark.sql(f"ALTER TABLE {here} UNSET TBLPROPERTIES IF EXISTS ('{_COMPLETE}')")
    if spark.catalog.tableExists(here):
        for old in olds:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(*database, old)}")


def _append_to_table(spark: SparkSession, here: str, beside: str, write, refuse: Callable[[], None]) -> None:
    """Let ``write`` fill a table of the same shape beside the table, then move
    the part files in, unless ``refuse`` raises."""
    folder = Folder(spark, _location(spark, here))
    folder.recover()
    new = folder.sibling("new")
    spark.sql(f"CREATE TABLE {beside} LIKE {here} LOCATION '{new.toString()}'")
    try:
        write(beside)  # Spark checks and casts as it would for the table itself
        refuse()
    except Exception:
        spark.sql(f"DROP TABLE {beside}")
        folder.fs.delete(new, True)
        raise
    spark.sql(f"DROP TABLE {beside}")  # an external one: its files stay
    folder.commit(new, ADD)
    spark.sql(f"REFRESH TABLE {here}")
    if any(c.isPartition for c in spark.catalog.listColumns(here)):
        spark.sql(f"ALTER TABLE {here} RECOVER PARTITIONS")


def write_table(
    df: DataFrame,
    table_name: str,
    database: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: Mapping[str, Any] | None = None,
    guard_empty: bool = True,
    bucket_by: tuple[int, list[str]] | None = None,
) -> str:
    """``df`` to a table of the session catalog; the database must exist. An
    overwrite fills a new table and swaps the names; an append moves its files
    in when they are complete. ``bucket_by`` (number, columns) deals a new table's
    rows out by a hash of the columns, sorted by them within a bucket. Returns
    the full name."""
    full_name = f"{database}.{table_name}" if database else table_name
    empty = f"Cannot load empty DataFrame as table {full_name}"
    above = [database] if database else []
    with _reported(f"as table {full_name}"):
        m = _mode(mode)
        _check_format(df, fmt)
        spark, here = df.sparkSession, _quoted(*above, table_name)
        if not database or spark.catalog.databaseExists(database):
            _recover_tables(spark, above, table_name)
        there = spark.catalog.tableExists(here)
        if there and m == "ignore":
            return full_name
        tag = uuid.uuid4().hex[:12]
        beside = _quoted(*above, f"{table_name}__new_{tag}")
        counted, seen = _counted(df)

        def refuse_empty() -> None:
            if guard_empty and not seen.get.get("rows"):
                raise LoadingError(empty)

        writer = _writer(counted, fmt, "append" if m == "append" else "errorifexists", options)
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
        if there and m == "append" and fmt in _FILE_FORMATS:
            _append_to_table(spark, here, beside, writer.saveAsTable, refuse_empty)
            return full_name
        spot = beside if there and m == "overwrite" else here
        writer.saveAsTable(spot)
        try:
            refuse_empty()
        except LoadingError:
            if spot != here or not there:
                spark.sql(f"DROP TABLE {spot}")
            raise
        if spot != here:
            spark.sql(f"ALTER TABLE {spot} SET TBLPROPERTIES ('{_COMPLETE}' = 'true')")
            _recover_tables(spark, above, table_name)
        return full_name


def write_keyed_table(
    df: DataFrame,
    table_name: str,
    keys: list[str],
    database: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    buckets: int | None = None,
    options: Mapping[str, Any] | None = None,
) -> str:
    """A table with one row per key of ``df``, bucketed and sorted by the keys,
    so that a later ``dedup`` or join by them plans no shuffle. An append adds
    rows of keys that may be there already; ``dedup`` over the table merges them.

    Rows of a key combine before they are dealt out, so a hot key is one row of
    its bucket. Buckets are as many as the shuffle's partitions unless given; then a
    bucket is one file a write."""
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, n = dedup(df, keys), buckets or shuffled
    if n != shuffled:
        rows = rows.repartition(n, *(F.col(f"`{k}`") for k in keys))
    return write_table(rows, table_name, database, fmt, mode, options, bucket_by=(n, keys))
