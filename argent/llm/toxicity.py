"""Operator 7, toxicity by compression distance.

Two zstandard dictionaries are made from labelled text. Both hold the most
frequent ordinary words; the toxic one also holds the word beginnings that
toxic text uses in many contexts and ordinary text does not, the ordinary one
the same number of unused bytes. Each window (a word, lower-cased, at most
``WINDOW`` bytes) is compressed with both. Because the dictionaries differ in
nothing else, the difference of the two lengths is zero for windows that the
toxic part doesn't help. A logistic model of the numbers of windows above each
difference, fitted on labelled rows kept out of the dictionaries, is the
calibrated threshold.

Labels only serve training, on bounded samples of labelled rows: at most
``DICTIONARY_ROWS`` and ``CALIBRATION_ROWS`` of each class, those with the
smallest hash of doc_id. Scoring covers every window of every text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, staged, texts

WINDOW = 64
DICTIONARY_ROWS = 6000
CALIBRATION_ROWS = 3000
SHARED_BYTES = 12_000  # of frequent ordinary words, in both dictionaries
TOXIC_SEGMENTS = 2048  # at most so many in the toxic dictionary
MIN_CONTEXTS = 8  # distinct preceding words that a toxic segment needs
MIN_LOG_ODDS = 2.5
SEGMENT_CHARS = range(4, 10)
MEMORY_WORDS = 250_000  # remembered at a time in a task
LEVELS = 8  # differences of 1 to 8 bytes are told apart
# Both dictionaries end with HEAD and every window starts with it, so that a
# block is always compressible; TAIL keeps the window clear of a block's last
# bytes, where zstandard looks for no matches.
HEAD = bytes(range(0x80, 0xC0))
TAIL = bytes(range(0x10, 0x1C))
_PARAMS = dict(
    window_log=16, chain_log=15, hash_log=15, search_log=6, min_match=4, target_length=64,
    strategy=zs.STRATEGY_BTLAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
)


def windows(text: str) -> list[str]:
    """Words in lower case; longer ones in pieces."""
    out = []
    for w in text.lower().split():
        if len(w) <= WINDOW // 4:
            out.append(w)
        else:
            out += [w[i : i + WINDOW // 4] for i in range(0, len(w), WINDOW // 4)]
    return out


@dataclass(frozen=True)
class ToxicityModel:
    shared: bytes
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # of the features, the last the bias

    def gains(self):
        """word -> bytes that the toxic dictionary saves, with a memory."""
        parameters = zs.ZstdCompressionParameters(**_PARAMS)
        made = []
        for part in (self.ordinary, self.toxic):
            data = zs.ZstdCompressionDict(self.shared + part + HEAD, dict_type=zs.DICT_TYPE_RAWCONTENT)
            made.append(zs.ZstdCompressor(dict_data=data, compression_params=parameters).compress)
        by_ordinary, by_toxic = made

        class Memory(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= MEMORY_WORDS:
                    self.clear()
                block = HEAD + b" " + word.encode() + b" " + TAIL
                self[word] = gain = max(0, len(by_ordinary(block)) - len(by_toxic(block)))
                return gain

        return Memory()

    def score(self, features: np.ndarray) -> float:
        z = float(np.dot(self.weights[:-1], features) + self.weights[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def features(text: str, memory) -> np.ndarray:
    words = windows(text)
    gains = np.fromiter(map(memory.__getitem__, words), np.int64, len(words))
    return np.array([math.log1p(int((gains >= g).sum())) for g in range(1, LEVELS + 1)])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(segment, toxic contexts, ordinary contexts): beginnings of words, and a
    64-bit sketch of the words that precede them, which bit_or merges."""
    for batch in batches:
        seen: dict[str, list[int]] = {}
        for t, toxic in zip(batch.column(0), batch.column(1)):
            before, kind = "", 0 if toxic.as_py() else 1
            for w in windows(t.as_py()):
                if len(w) >= SEGMENT_CHARS[0]:
                    bit = 1 << (xxhash.xxh3_64_intdigest(before) & 63)
                    for k in range(SEGMENT_CHARS[0], min(len(w), SEGMENT_CHARS[-1]) + 1):
                        entry = seen.setdefault(w[:k], [0, 0])
                        entry[kind] |= bit
                before = w
        cols = [np.array([v[k] for v in seen.values()], np.uint64).view(np.int64) for k in (0, 1)]
        yield pa.record_batch([pa.array(list(seen), pa.string()), *map(pa.array, cols)], ["segment", "toxic", "ordinary"])


def _distinct(sketch: str) -> Column:
    """Linear counting with 64 bits."""
    ones = F.bit_count(sketch)
    return F.when(ones >= 64, F.lit(64 * math.log(128))).otherwise(-64 * F.log((64 - ones) / F.lit(64.0)))


def choose(found: list[tuple[str, float, float]]) -> list[str]:
    """Of nested segments, the one with the highest odds, then the longest."""
    kept: list[str] = []
    for segment, _, _ in sorted(found, key=lambda s: (-round(s[1], 6), -len(s[0]), s[0])):
        if not any(segment.startswith(k) or k.startswith(segment) for k in kept):
            kept.append(segment)
    return kept


def _sampled(docs: DataFrame, marks: DataFrame, rows: int) -> DataFrame:
    """The texts of at most ``rows`` labelled rows of each class, by hash of
    doc_id. What is sent to every task is the doc_ids, bounded by ``rows``."""
    each = [marks.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for t in (0, 1)]
    return docs.join(F.broadcast(each[0].unionByName(each[1])), "doc_id").select("text", "toxic")


def _feature_rows(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory = model.gains()
            rows = [features(t.as_py(), memory) for t in batch.column(0)]
            yield pa.record_batch([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["f", "toxic"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, dictionary_rows: int = DICTIONARY_ROWS, calibration_rows: int = CALIBRATION_ROWS
) -> ToxicityModel:
    """Train on the texts of labelled documents: (doc_id, text) and (doc_id,
    toxic). Labels other than 0 and 1 and labels without a document are
    ignored; of conflicting ones the larger counts. Without rows of both
    classes the score is the share of toxic ones (0 without any)."""
    spark = docs.sparkSession
    docs = texts(docs, "doc_id", "text")
    marks = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    marks = staged(marks, "op7-marks")
    counts = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    prior = (n1 + 0.5) / (n0 + n1 + 1) if n1 else 1e-6
    flat = (0.0,) * LEVELS + (math.log(prior / (1 - prior)),)
    if not n0 or not n1:
        return ToxicityModel(b" ", b" ", b" ", flat)
    fold = F.pmod(F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string"))), F.lit(4))
    first = staged(_sampled(docs, marks.filter(fold != 0), dictionary_rows), "op7-dictionary")
    again = _sampled(docs, marks.filter(fold == 0), calibration_rows)

    segments = (
        first.select("text", (F.col("toxic") == 1).alias("toxic"))
        .repartition(spark.sparkContext.defaultParallelism)
        .mapInArrow(_segments, "segment string, toxic long, ordinary long")
        .groupBy("segment")
        .agg(F.bit_or("toxic").alias("toxic"), F.bit_or("ordinary").alias("ordinary"))
        .select("segment", _distinct("toxic").alias("t"), _distinct("ordinary").alias("o"))
    )
    sizes = {r.toxic: r.n for r in first.groupBy("toxic").agg(F.sum(F.length("text")).alias("n")).collect()}
    odds = F.log((F.col("t") + 0.5) / max(1, sizes.get(1) or 1)) - F.log((F.col("o") + 0.5) / max(1, sizes.get(0) or 1))
    found = (
        segments.withColumn("odds", odds).filter((F.col("t") >= MIN_CONTEXTS) & (F.col("odds") >= MIN_LOG_ODDS))
        .orderBy(F.desc("odds"), "segment").limit(TOXIC_SEGMENTS).collect()
    )
    chosen = choose([(r.segment, r.odds, r.t) for r in found])
    words = (
        first.filter("toxic = 0").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("w")).filter("w <> ''")
        .groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(SHARED_BYTES // 2).collect()
    )
    shared = b" ".join(r.w.encode()[:WINDOW] for r in words)[:SHARED_BYTES]
    # The nearest bytes cost least: the most frequent words come last.
    shared = b" " + b" ".join(reversed(shared.split(b" "))) + b" "
    toxic = b" " + b" ".join(s.encode() for s in reversed(chosen)) + b" "
    model = ToxicityModel(shared, b"\x00" * len(toxic), toxic, flat)

    rows = again.repartition(spark.sparkContext.defaultParallelism)
    rows = rows.mapInArrow(_feature_rows(model), "f array<double>, toxic int").collect()
    y = np.array([float(r.toxic) for r in rows])
    if len(set(y)) < 2:
        return model
    x = np.array([r.f for r in rows])
    order = np.lexsort((*x.T, y))  # whatever order the rows came in
    x, y = x[order], y[order]
    # The classes weigh as often as they occur among all labelled rows.
    weight = np.where(y == 1, n1 / (y == 1).sum(), n0 / (y == 0).sum()) * len(y) / (n0 + n1)
    return ToxicityModel(shared, model.ordinary, toxic, tuple(fit_logistic(x, y, weight).tolist()))


def _score(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory = model.gains()  # anew for each batch, so that it stays small
            scores = [model.score(features(t.as_py(), memory)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), *batch.columns[1:]], names=["score", *batch.schema.names[1:]])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on), one row per row. A
    null text scores as the empty one, an empty table gives an empty result;
    equal texts have equal scores."""
    base = texts(docs, id_col, text_col).select("text", "doc_id")
    id_type = base.schema["doc_id"].dataType.simpleString()
    scored = base.mapInArrow(_score(model), f"score double, doc_id {id_type}")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _clean(model: ToxicityModel, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory = model.gains()
            score = [model.score(features(t.as_py() or "", memory)) for t in batch.column(position)]
            yield batch.filter(pa.array([s < 0.5 for s in score], pa.bool_()))

    return run


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose text is not predicted toxic."""
    return docs.mapInArrow(_clean(model, docs.columns.index(text_col)), docs.schema)


def held_out(column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5)) == 0


def query_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ToxicityModel:
    """Learned from the labels that are not held out."""
    return fit_toxicity(docs, load(spark, sf_dir, "labels").filter(~held_out()))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score_toxicity(docs, query_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
