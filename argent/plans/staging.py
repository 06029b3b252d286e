"""Stage derived tables as files in the session's shared folder.

Used to feed the file scans and the whole job with inputs that Spark derives
from the driver tables. Every call writes a fresh directory (written by the
executors through Spark's commit protocol), so runs never collide.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

from argent.session import scratch_path

# CSV writer options that keep padded strings as they are.
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def stage_csv(
    df: DataFrame,
    label: str,
    header: bool = True,
    sep: str = ",",
    options: Mapping[str, Any] | None = None,
) -> str:
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists").option("header", header).option("sep", sep)
    for k, v in {**KEEP_BLANKS, **(options or {})}.items():
        writer = writer.option(k, v)
    writer.csv(path)
    return path


def stage_text(df: DataFrame, label: str) -> str:
    """Write a single string column as lines of text."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").text(path)
    return path


def stage_parquet(df: DataFrame, label: str, path: str | None = None) -> str:
    path = path or scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return path
