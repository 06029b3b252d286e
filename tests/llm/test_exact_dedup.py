import hashlib
from collections import defaultdict

from argent.llm.exact_dedup import exact_dedup


def _brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    long = "p" * 500
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, long + "x"), (6, long + "y"), (7, long + "x"), (None, "a"), (None, "alone"), (8, "A"), (9, "漢"), (10, "abc")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, sha string")
    for buckets in (1 << 18, 1):  # 1: every bucket is shared, the last level decides
        got = exact_dedup(df, digest_all=True, buckets=buckets)
        assert sorted(map(tuple, got.collect()), key=str) == _brute(rows)
    assert exact_dedup(df.limit(0)).count() == 0


def test_settled_rows_are_not_read_in_full(spark):
    df = spark.createDataFrame([(1, "one"), (2, "three"), (3, "four!"), (4, "three")], "doc_id long, text string")
    got = {r.doc_id: r.text_sha256 is not None for r in exact_dedup(df).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True}


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    plan = exact_dedup(df)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian"))
