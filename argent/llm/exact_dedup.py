"""Operator 8, exact dedup by progressive refinement (native).

Rows are grouped by byte length, the rows of repeated lengths by a hash of
their prefix, and only rows still in a group of several are read in full and
hashed with SHA-256. The first two groupings are kept as sets of repeated
hash buckets, at most ``buckets`` rows each whatever the input, so they can be
broadcast and no text is ever shuffled; two groups that share a bucket merely
both go on to the next level. The last grouping is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, staged, texts

PREFIX_CHARS = 128
BUCKETS = 1 << 18


def _repeated(df: DataFrame, bucket: str) -> DataFrame:
    """Hash buckets with several rows: at most BUCKETS rows."""
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(bucket)


def _bucket(buckets: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    buckets: int = BUCKETS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays. A null text equals
    the empty text. ``text_sha256`` is filled for the rows whose content had
    to be read in full, or for all with ``digest_all``. Rows that repeat both
    doc_id and text count in ``group_size`` and share their verdict; a null
    doc_id ranks below every other. An empty table gives an empty result.
    """
    base = texts(docs, id_col, text_col)
    by_len = base.withColumn("b1", _bucket(buckets, F.octet_length("text")))
    long_sets = _repeated(by_len, "b1")
    level1 = by_len.join(F.broadcast(long_sets), "b1")
    prefix = F.substring("text", 1, prefix_chars)
    by_prefix = _bucket(buckets, F.octet_length("text"), prefix)
    prefix_sets = _repeated(level1.select(by_prefix.alias("b2")), "b2")

    marked = (
        by_len.join(F.broadcast(long_sets.withColumn("m1", F.lit(True))), "b1", "left")
        .withColumn("b2", F.when(F.col("m1"), by_prefix))
        .join(F.broadcast(prefix_sets.withColumn("m2", F.lit(True))), "b2", "left")
    )
    survives = F.coalesce(F.col("m2"), F.lit(False))
    full = F.sha2(F.col("text"), 256)
    hashed = marked.select(
        "doc_id",
        survives.alias("survives"),
        (full if digest_all else F.when(survives, full)).alias("text_sha256"),
    )
    hashed = staged(hashed, "op8-hashes")

    groups = (
        hashed.filter("survives")
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
        .filter("n > 1")
    )
    # Written out so that the join below reads plain exchanges, whose hot
    # digests adaptive execution can split.
    groups = staged(groups, "op8-groups").withColumnRenamed("text_sha256", "sha")
    keep = F.when(F.col("n").isNotNull(), F.col("last")).otherwise(F.col("doc_id"))
    return (
        hashed.join(groups, (F.col("text_sha256") == F.col("sha")) & F.col("survives"), "left")
        .select(
            "doc_id",
            keep.alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            F.col("doc_id").eqNullSafe(keep).alias("kept"),
            "text_sha256",
        )
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(load(spark, sf_dir, "documents"), digest_all=True)


ORACLE_OP8 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
