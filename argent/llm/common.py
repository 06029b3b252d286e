"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.session import scratch_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder (zstd Parquet) and read back: cuts lineage
    in a way that survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete staged tables whose successors stand: what was made from them has
    been written out itself, so that nothing, lost executors included, asks for
    them again."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.staged_at)  # noqa: SLF001
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def texts(docs: DataFrame, id_col: str, text_col: str, null_as: str | None = "") -> DataFrame:
    """(doc_id, text): only the two columns an operator needs, so that extra
    columns can never clash; a null text reads as ``null_as``."""
    text = F.col(f"`{text_col}`").cast("string")
    if null_as is not None:
        text = F.coalesce(text, F.lit(null_as))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))


def bitmap(values: DataFrame, column: str, bits: int) -> list[int]:
    """A fixed-size membership bitmap of 64-bit hashes, as 64-bit words.

    The result has 2**bits bits whatever the input size (the proven bound that
    lets it be sent everywhere); it has no false negatives, and false
    positives only send rows on to the exact step that follows."""
    slot = F.pmod(F.col(column), F.lit(1 << bits).cast("long"))
    words = (
        values.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", F.lit(64)).cast("int"))).alias("v"))
    )
    out = [0] * (1 << (bits - 6))
    for r in words.toLocalIterator():
        out[r["word"]] = r["v"]
    return out


def in_bitmap(h: Column, table: Column, bits: int) -> Column:
    """Native test of a 64-bit hash against a ``bitmap`` held in an array column."""
    slot = F.pmod(h, F.lit(1 << bits).cast("long"))
    word = F.get(table, F.shiftright(slot, 6).cast("int"))
    return F.getbit(word, F.pmod(slot, F.lit(64)).cast("int")) == 1
