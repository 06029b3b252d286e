import math
import random
from fractions import Fraction

import numpy as np
import pytest

from argent.llm.whitening import _limbs, op13_whitening, square_sums, whiten

SF = "/root/testdata/sf0.001"


def _brute(rows):
    """(kept rows with their x, n, S, V as exact fractions) by plain loops."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    width = max(set(sizes), key=lambda w: (sizes.count(w), w)) if good else 0
    kept = [(i, tuple(max(-(2**63), min(2**63 - 1, math.floor(256 * c) if math.isfinite(256 * c) else math.copysign(2**63, c))) for c in v)) for i, v in good if len(v) == width]
    kept = [(i, tuple(map(int, x))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n = len(fit)
    sums = [sum(x[k] for x in fit) for k in range(width)]
    cov = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n**3) for j in range(width)] for i in range(width)]
    return kept, n, sums, cov


def _check(rows, got):
    kept, n, sums, cov = _brute(rows)
    k = min(4, len(sums))
    assert sorted((repr(r.vec_id), r.component) for r in got) == sorted((repr(i), c) for i, _ in kept for c in range(1, k + 1))
    if not kept:
        return
    v = np.array(cov, dtype=float)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    trace = float(sum(cov[d][d] for d in range(len(sums))))
    byrow = {}
    for r in got:
        byrow.setdefault((repr(r.vec_id), r.component), []).append(r)
    sign = [None] * k
    by_id = {}
    for i, x in kept:
        by_id.setdefault(repr(i), []).append(x)
    for i, xs in by_id.items():
        for c in range(k):
            rs = byrow[i, c + 1]
            want = []
            for x in xs:
                y = [n * a - s for a, s in zip(x, sums)]
                dev = sum(a * a for a in y)
                live = e[c] > 1e-12 * trace
                z = float(np.array([float(Fraction(a, n)) for a in y]) @ u[:, c] / math.sqrt(e[c])) if live else None
                want.append((dev if dev < 2**63 else None, z))
            assert len(rs) == len(want)
            for r, (dev, z) in zip(sorted(rs, key=lambda r: (r.deviation or 0, abs(r.whitened or 0))), sorted(want, key=lambda w: (w[0] or 0, abs(w[1] or 0)))):
                assert r.n == n and r.deviation == dev
                assert (r.whitened is None) == (z is None)
                if z is not None:
                    assert abs(r.whitened) == pytest.approx(abs(z), rel=1e-6, abs=1e-6)
                    if abs(z) > 1e-3:
                        s = math.copysign(1, r.whitened * z)
                        assert sign[c] in (None, s)
                        sign[c] = s
                if trace:
                    assert r.explained == pytest.approx(max(0.0, e[c] / trace), rel=1e-6, abs=1e-9)
                else:
                    assert r.explained is None
                assert r.identity_error is None or r.identity_error < 1e-6


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<double>, x string")


def test_square_sums_are_exact():
    rng = random.Random(1)
    for bits in (3, 20, 31, 45, 46, 55, 60):
        rows = [[rng.randrange(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(200)]
        want = [sum(r[k] ** 2 for r in rows) for k in range(3)]
        assert square_sums(np.array(rows, np.int64)) == want == square_sums(np.array(rows, object))
    assert square_sums(np.zeros((0, 2), np.int64)) == [0, 0]
    assert sum(v << 48 * k for k, v in enumerate(_limbs(7**90))) == 7**90


def test_against_brute_force_on_awkward_rows(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 1 + d) for d in range(6)]) for k in range(80)]
    rows += [(200 + k, rows[3][1]) for k in range(120)]  # one vector holds most rows
    rows += [(None, rows[5][1]), (None, [0.5] * 6), (300, None), (301, []), (302, [1.0] * 5), (303, [1.0, None, 2.0, 3.0, 4.0, 5.0])]
    rows += [(304, [float("nan")] * 6), (305, [0.0] * 5 + [float("-inf")]), (306, [-0.0] * 6), (7, rows[8][1])]
    for parts in (1, 7):
        _check(rows, whiten(_frame(spark, rows).repartition(parts)).collect())


@pytest.mark.parametrize("scale", [1e6, 1e12, 1e300])
def test_large_entries(spark, scale):
    rng = random.Random(3)
    rows = [(k, [rng.uniform(-1, 1) * scale, rng.uniform(-1, 1) * min(scale, 1e16), rng.gauss(0, 1)]) for k in range(30)]
    _check(rows, whiten(_frame(spark, rows)).collect())


def test_no_variance(spark):
    for rows in ([(1, [0.25, 0.5])] * 3, [(1, [1.0, 0.0, 2.0]), (2, [2.0, 0.0, 2.0])], [(1, [3.0])]):
        got = whiten(_frame(spark, rows)).collect()
        _check(rows, got)
    assert whiten(_frame(spark, [])).count() == 0 == whiten(_frame(spark, [(1, None), (2, [])])).count()


def test_the_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = op13_whitening(spark, SF).collect()
    _check(rows, got)
    assert max(r.identity_error for r in got) < 1e-9


def test_the_fit_does_not_depend_on_partitions(spark):
    rows = [(k, [math.sin(k * (d + 1)) for d in range(4)]) for k in range(60)]
    a, b = ({(r.vec_id, r.component): r.deviation for r in whiten(_frame(spark, rows).repartition(p)).collect()} for p in (1, 9))
    assert a == b
