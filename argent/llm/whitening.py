"""Operator 13, whitening of embeddings by polarisation covariance.

Entries become whole numbers, x = floor(scale * c), and the fit list is every
distinct x once. With n vectors and per-dimension sums S, the centred values
n*x - S are whole numbers as well. The only aggregates are exact sums of squares:
of the centred values of every dimension, and of their sum for every pair of
dimensions. The polarisation identity

    2 cov(a, b) = var(a + b) - var(a) - var(b)

recovers all covariances from these variances in whole numbers, so each entry of
the matrix is the nearest double. The matrix, of a size that the dimension sets,
is decomposed by eigh, and every row is projected.

Squares are summed in 64-bit numbers after a split in high and low parts, and a
task adds its parts in whole numbers of any size: nothing overflows or rounds,
whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, staged

SCALE = 256
COMPONENTS = 4
SPLIT = 24  # bits of the low part of a value under 2**46
ROWS = 4096  # at a time: 2**12 squares of 2**46 and less stay under 2**63
LIMB, LIMBS = 48, 6  # how a task's sums travel
NO_VARIANCE = 1e-12  # of the trace; a component under it has no direction


def _reach(values: np.ndarray) -> int:
    """The largest absolute value, as a whole number of Python's."""
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def square_sums(values: np.ndarray) -> list[int]:
    """The exact sum of squares of every column of whole numbers."""
    if values.dtype != object and _reach(values) < 1 << 46:
        high, low = values >> SPLIT, values & ((1 << SPLIT) - 1)
        parts = zip((high * high).sum(0).tolist(), (high * low).sum(0).tolist(), (low * low).sum(0).tolist())
        return [(h << 2 * SPLIT) + (m << SPLIT + 1) + l for h, m, l in parts]
    return [sum(int(v) ** 2 for v in column) for column in values.T]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S; as Python's whole numbers where 64 bits might not do."""
    if n * _reach(x) + max(map(abs, sums)) >= 1 << 61:
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def _limbs(value: int) -> list[int]:
    return [value >> LIMB * k & ((1 << LIMB) - 1) for k in range(LIMBS)]


def _polarised(n: int, sums: list[int]):
    """Per task: (i, i) sums of squares of dimension i, (i, j) of the sum of i and j."""
    width = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = [0] * width
        pairs = [[0] * (width - i - 1) for i in range(width)]
        for batch in batches:
            whole = _matrix(batch.column(0), width)
            for at in range(0, len(whole), ROWS):
                y = centred(whole[at : at + ROWS], n, sums)
                alone = [a + b for a, b in zip(alone, square_sums(y))]
                for i in range(width - 1):
                    pairs[i] = [a + b for a, b in zip(pairs[i], square_sums(y[:, i + 1 :] + y[:, i : i + 1]))]
        keys = [(i, i) for i in range(width)] + [(i, j) for i in range(width) for j in range(i + 1, width)]
        values = [_limbs(v) for v in [*alone, *(v for row in pairs for v in row)]]
        cols = [pa.array(c, pa.int32()) for c in zip(*keys)] + [pa.array(c, pa.int64()) for c in zip(*values)]
        yield pa.record_batch(cols, ["i", "j", *(f"v{k}" for k in range(LIMBS))])

    return run


@dataclass
class Whitening:
    """A fitted whitening: the n vectors of the fit list, their sums, and the
    leading eigenvalues and unit eigenvectors (rows) of their covariance."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None = None

    def has_variance(self) -> np.ndarray:
        return self.values > NO_VARIANCE * self.trace

    def whiten(self, y: np.ndarray) -> np.ndarray:
        """Coordinates of centred rows (n*x - S), nan where there is no variance."""
        scale = np.where(self.has_variance(), np.sqrt(np.maximum(self.values, 1e-300)), np.nan)
        return (y.astype(float) / self.n) @ self.vectors.T / scale


def _projected(fitted, mean: np.ndarray | None):
    """Per task: sums of the whitened coordinates, or of their centred products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Whitening = fitted
        total = np.zeros((len(w.values),) * (1 if mean is None else 2))
        for batch in batches:
            z = w.whiten(centred(_matrix(batch.column(0), len(w.sums)), w.n, w.sums))
            total += z.sum(0) if mean is None else (z - mean).T @ (z - mean)
        yield pa.record_batch([pa.array(range(total.size), pa.int32()), pa.array(total.ravel(), pa.float64())], ["k", "v"])

    return run


def _sums(df: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in df.groupBy("k").agg(F.sum("v").alias("v")).collect():  # components squared at most
        out[r["k"]] = r["v"]
    return out


def fit(x: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors ``x`` of ``width`` whole numbers; None
    if there are none. What reaches the driver has width**2 numbers at most."""
    totals = x.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    got = {r["k"]: r for r in totals.collect()}
    if not got:
        return None
    n, sums = got[0]["n"], [int(got[k]["s"]) for k in range(width)]

    schema = "i int, j int, " + ", ".join(f"v{k} long" for k in range(LIMBS))
    squares = x.select("x").mapInArrow(_polarised(n, sums), schema).groupBy("i", "j")
    squares = squares.agg(*(F.sum(F.col(f"v{k}").cast("decimal(38,0)")).alias(f"v{k}") for k in range(LIMBS)))
    exact = {(r["i"], r["j"]): sum(int(r[f"v{k}"]) << LIMB * k for k in range(LIMBS)) for r in squares.toLocalIterator()}
    cov = np.zeros((width, width))
    for i, j in exact:
        twice = 2 * exact[i, i] if i == j else exact[i, j] - exact[i, i] - exact[j, j]
        cov[i, j] = cov[j, i] = twice / (2 * n**3)  # whole numbers: the nearest double
    values, vectors = np.linalg.eigh(cov)
    top = np.argsort(-values, kind="stable")[:components]
    vectors = vectors.T[top]
    vectors *= np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(1)[:, None], 1) < 0, -1.0, 1.0)
    trace = sum(exact[i, i] for i in range(width)) / n**3
    w = Whitening(n, sums, trace, values[top], vectors)

    live = w.has_variance()
    if live.any():
        k = len(w.values)
        mean = _sums(x.select("x").mapInArrow(_projected(w, None), "k int, v double"), k) / n
        got = _sums(x.select("x").mapInArrow(_projected(w, mean), "k int, v double"), k * k).reshape(k, k) / n
        w.identity_error = float(np.abs(got - np.eye(k))[np.ix_(live, live)].max())
    return w


def _rows(w: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(w.values)
        live = w.has_variance()
        for batch in batches:
            y = centred(_matrix(batch.column(1), len(w.sums)), w.n, w.sums)
            exact = y if _reach(y) ** 2 * len(w.sums) < 1 << 63 else y.astype(object)
            deviation = [int(v) if v < 1 << 63 else None for v in (exact * exact).sum(1)]
            z = w.whiten(y)
            m = len(y)
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n, np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(z.ravel(), mask=~np.tile(live, m)),
                    pa.array(np.tile(np.maximum(w.values, 0) / (w.trace or 1), m), mask=np.full(m * k, not w.trace)),
                    pa.array([w.identity_error] * (m * k), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one
    row per remaining row and component, by falling eigenvalue.

    A row whose vector is null, empty, or holds a null or non-finite entry goes,
    as does one whose length is not the most frequent length (of equally
    frequent ones the larger): it has no place in the matrix. Rows that repeat
    a vector count once in the fit, however many they are, and each has its
    result; ids may be null or repeat. An entry too large for a long takes the
    nearest long; a deviation beyond a long is null. A component without variance
    (all vectors equal, or fewer vectors than components) has null coordinates
    and no part in ``identity_error``; ``explained`` is null if nothing varies.
    An empty table gives an empty result. Other columns are not looked at.
    """
    spark = embeddings.sparkSession
    id_type = embeddings.schema[id_col].dataType.simpleString()
    c = F.col("c")
    rows = embeddings.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("c"))
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    rows = rows.filter((F.size(c) > 0) & finite)
    widths = rows.groupBy(F.size("c").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = widths.orderBy(F.desc("n"), F.desc("width")).first()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if most is None:
        return spark.createDataFrame([], schema)
    x = F.transform(c, lambda e: F.floor(e * scale))  # a long; the nearest one beyond its range
    rows = rows.filter(F.size("c") == most["width"]).select("vec_id", x.alias("x"))
    distinct = staged(rows.select("x").distinct(), "op13-fit")
    w = fit(distinct, most["width"], components)
    return rows.mapInArrow(_rows(w), schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(load(spark, sf_dir, "embeddings"))
