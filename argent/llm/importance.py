"""Operator 11, target-distribution importance resampling over hashed n-grams.

1. A 256-byte table lower-cases A-Z and blanks every separator in a text's
   UTF-8, and bytes.split yields its words.
2. Chained zlib.crc32 seeds extend the n-grams: the crc of "a b" is that of
   " b" seeded with the crc of "a", so no n-gram is ever built as a string.
3. A Counter of buckets reduces each batch of texts; Spark adds the counters up
   for the documents and for the target texts.
4. A bucket's gain is a whole number from its two counts; a document's weight is
   the sum of gains over its features. Gumbel noise from a hash of doc_id makes
   the highest scores a draw without replacement.
5. The draw is a range sort of narrow rows with an exact rank from the sizes of
   the sorted partitions; no partition holds more than its share, also when
   many rows tie.

Texts are hashed twice (to count and to score), since that is cheaper than
storing three features a word. A task holds the buckets of one piece of a text
at a time, so a very long text costs time but no memory beyond its own bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, staged, texts

BUCKETS = 10_000
ORDER = 3  # longest run of words
MIN_WORDS = 20
SHARE = (5, 100)
SEED = 42
SCALE = 1000  # gains and noise are floors of thousandths
PIECE_BYTES = 1 << 20

_WORD = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
TABLE = bytes(b if b in _WORD else 0x20 for b in bytes(range(256)).lower())


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of one text, some ``size`` bytes of it at a time."""
    data, at = data.translate(TABLE), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def hashes(data: bytes, order: int = ORDER, size: int = PIECE_BYTES) -> Iterator[tuple[int, list[list[int]]]]:
    """For each piece: its number of words and, for every n, the crc32 of the
    runs of n words that end in it."""
    before: list[int | None] = [None] * order  # the crc of the n words before this piece
    for words in pieces(data, size):
        if not words:
            continue
        spaced = [b" " + w for w in words]
        grams = [list(map(crc32, words))]
        for n in range(1, order):
            seeds = [before[n - 1] or 0, *grams[-1][:-1]] if before[n - 1] is not None else grams[-1][:-1]
            skip = len(words) - len(seeds)
            grams.append(list(map(crc32, spaced[skip:], seeds)))
        before = [g[-1] if g else None for g in grams]
        yield len(words), grams


def _counts(buckets: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[int] = Counter()  # at most ``buckets`` entries
        for batch in batches:
            for t in batch.column(0):
                for _, grams in hashes(t.as_py().encode(), order):
                    n.update((np.fromiter(chain.from_iterable(grams), np.uint32) % np.uint32(buckets)).tolist())
        yield pa.record_batch([pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64())], ["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """Features of a ``text`` column by bucket: ``buckets`` numbers, whatever the input."""
    counted = docs.select("text").mapInArrow(_counts(buckets, order), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The whole-number gain of every bucket, with one added to each count."""
    wide, narrow = float(raw.sum() + len(raw)), float(target.sum() + len(target))
    out = [math.floor(SCALE * math.log((t + 1.0) * wide / ((s + 1.0) * narrow))) for s, t in zip(raw.tolist(), target.tolist())]
    return np.array(out, np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise in thousandths from a hash of the id; a null id is empty text."""
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(table, order: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = table.value
        size = np.uint32(len(gain))
        for batch in batches:
            words, features, weight, score = [], [], [], []
            for i, t in zip(batch.column(0), batch.column(1)):
                n = m = w = 0
                for k, grams in hashes(t.as_py().encode(), order):
                    at = np.fromiter(chain.from_iterable(grams), np.uint32) % size
                    n, m, w = n + k, m + len(at), w + int(gain[at].sum())
                words.append(n), features.append(m), weight.append(w)
                score.append(w + noise(i.as_py(), seed))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weight, score))],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return run


def _ranked(rows: DataFrame, eligible: str, order: list) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in ``order`` over the ``eligible`` ones.

    The sorted rows are written once, each with the number of its partition and
    its place there; the eligible rows of earlier partitions, one number a
    partition, give the offset."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(eligible).desc(), *order]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ordered = staged(ordered.withColumn("at", F.monotonically_increasing_id()), "op11-ordered")
    ordered = ordered.withColumn("part", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND((1 << 33) - 1))
    sizes = ordered.filter(eligible).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets, seen = [], 0
    for r in sorted(sizes.collect(), key=lambda r: r["part"]):  # one row a shuffle partition
        offsets.append((r["part"], seen))
        seen += r["n"]
    offsets = spark.createDataFrame(offsets, "part long, before long")
    ordered = ordered.join(F.broadcast(offsets), "part", "left")
    return ordered.withColumn("rank", F.when(F.col(eligible), F.col("before") + F.col("place") + 1)).drop("part", "place", "before", "at")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    share: tuple[int, int] = SHARE,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    order: int = ORDER,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank, one row per row.

    Of the N rows with at least ``min_words`` words, floor(share * N) are drawn:
    those of the highest scores, ties to the smaller doc_id (a null one last);
    ``rank`` counts them from 1 and is null for all others. A null or empty text
    has no words, no features and weight 0. Rows that repeat a doc_id are rows of
    their own with the same noise; equal ones among them come in any order. A
    very long text is hashed whole, in pieces. Without target texts all of a
    document's gains follow from the documents alone; an empty table of
    documents gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    base = texts(docs, id_col, text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()
    gain = gains(
        bucket_counts(base, buckets, order),
        bucket_counts(target.select(F.coalesce(F.col(f"`{target_text}`").cast("string"), F.lit("")).alias("text")), buckets, order),
    )
    scored = base.mapInArrow(
        _score(spark.sparkContext.broadcast(gain), order, seed),
        f"doc_id {id_type}, n_words long, n_features long, weight long, score long",
    )
    scored = scored.withColumn("enough", F.col("n_words") >= min_words).withColumn("tie", F.monotonically_increasing_id())
    scored = staged(scored, "op11-scored")
    n = scored.filter("enough").count()
    ranked = _ranked(scored, "enough", [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tie")])
    rank = F.when(F.col("rank") <= share[0] * n // share[1], F.col("rank"))
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance_resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
