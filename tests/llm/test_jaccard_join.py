import random
import re

import numpy as np
import pyarrow as pa
import pytest

from argent.llm import jaccard_join
from argent.llm.components import components
from argent.llm.jaccard_join import Plan, _WordHashes, counts, jaccard_components, op6_jaccard_join, shingles, survivors

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def _set(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def _brute(rows, size=3, num=9, den=10):
    sets = [_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for v in where.values() for k, a in enumerate(v) for b in v[k + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op6_jaccard_join(spark, SF).collect()), key=str)
    assert got == _brute(rows)
    assert len({r[2] for r in got}) < len(got)


@pytest.mark.parametrize("size,num,den", [(3, 9, 10), (5, 8, 10)])
def test_families_against_brute_force(spark, size, num, den, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 7)
    monkeypatch.setattr(jaccard_join, "BEST_ROUNDS", 1)
    rng = random.Random(size)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for f in range(12):
        body = [rng.choice(words) for _ in range(rng.choice([4, 12, 40, 90, 150]))]
        for _ in range(14):
            new = list(body)
            for _ in range(rng.randint(0, max(1, len(body) // 25))):
                new[rng.randrange(len(new))] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(new)))
            if rng.random() < 0.3:
                body = new
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (None, rows[0][1]), rows[3], rows[3], (906, "é É"), (907, "É É")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, sid long").repartition(3)
    got = jaccard_components(df, shingle=size, threshold=(num, den)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows, size, num, den)
    assert jaccard_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("num", [8, 9])
def test_no_link_is_missed_by_cells_or_bounds(num):
    rng = np.random.default_rng(5)
    plan = Plan(num, 10)
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop, add = rng.integers(0, max(1, n // 8) + 1, 2)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        if 10 * both >= num * (len(a) + len(b) - both):
            assert plan.enough(both, len(a), len(b)) and set(plan.cells(a).tolist()) & set(plan.cells(b).tolist())
            points = np.stack([counts(a), counts(b)])
            got = list(survivors(plan, np.array([len(a), len(b)]), points, np.array([0]), np.array([1])))
            assert len(got) == 1 and got[0][1].tolist() == [1] and got[0][2][0] >= both
        else:
            assert not plan.enough(both, len(a), len(b))


def test_points_of_any_width():
    sets = [np.arange(n, dtype=np.uint64) << np.uint64(44) + np.uint64(k) for n, k in ((3, 0), (5000, 1), (80_000, 8))]
    blobs = [counts(h).tobytes() for h in sets]
    assert len(blobs[0]) < len(blobs[2])  # 80,000 of one group need 32 bits
    for some in (blobs, blobs[:2], blobs[2:]):
        assert jaccard_join.points(some).sum(1).tolist() == [len(h) for h, b in zip(sets, blobs) if b in some]


def test_shingles_and_components(spark):
    assert len(shingles("a b a b a b", _WordHashes(), 3)) == 2
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 103), (103, 101), (7, 7), (200, 199)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100, 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cells_that_run_over_batches():
    rng = random.Random(8)
    for _ in range(200):
        rows = sorted((rng.randrange(4), rng.randrange(5)) for _ in range(rng.randint(0, 25)))
        batches, k = [], 0
        while k < len(rows):
            z = k + rng.randint(0, 6)
            part = rows[k:z]
            batches.append(pa.record_batch([pa.array([r[c] for r in part], pa.int64()) for c in (0, 1)], ["cell", "sid"]))
            k = z
        got = sorted(tuple(r.values()) for b in jaccard_join._shared_cells(iter(batches)) for r in b.to_pylist())
        cells = {}
        for c, s in rows:
            cells.setdefault(c, set()).add(s)
        assert got == sorted((c, s, min(v)) for c, v in cells.items() if len(v) > 1 for s in v)
