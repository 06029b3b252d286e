import random

import pytest

from argent.llm.line_dedup import _places, line_dedup

SF = "/root/testdata/sf0.01"


def _brute(rows, window, long_words=50):
    """(doc_id, text) -> (kept text, removed line numbers); rows in order. A run
    is ``window`` lines, or one of more than ``long_words`` words."""
    units = {}
    order = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1] is not None}, key=lambda k: k[:2])
    for k in order:
        units[k] = [(n, x.strip(" \t\r")) for n, x in enumerate(k[2].split("\n")) if x.strip(" \t\r")]
    seen, gone = set(), {k: set() for k in order}
    for k in order:
        for s, (_, x) in enumerate(units[k]):
            for width in {window, 1} if len(x.split()) > long_words else {window}:
                content = tuple(x for _, x in units[k][s : s + width])
                if len(content) == width:
                    if content in seen:
                        gone[k] |= {n for n, _ in units[k][s : s + width]}
                    seen.add(content)
    out = []
    for i, t, *_ in rows:
        g = gone.get((i is not None, i or 0, t), set())
        kept = t if not g else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g)
        out.append((i, kept, sorted(g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [1, 2, 3])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    lines = [f"line {k}" for k in range(12)] + ["", "  ", " line 3\t", "漢字"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14)))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, rows[0][1]), rows[5], rows[5], (202, "x\n" * 3000), (203, rows[3][1])]
    df = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, text string, removed string").repartition(5)
    got = sorted(((r.doc_id, r.text, list(r.removed)) for r in line_dedup(df, window=window).collect()), key=str)
    assert got == _brute(rows, window)


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a\nb", "n"), (2, "a\nb\nc", "m")], "doc_id long, text string, n_lines string")
    got = {r.doc_id: r for r in line_dedup(df).collect()}
    assert got[2].text == "c" and got[2].row.n_lines == "m" and got[2].n_lines == 3 and got[1].n_removed == 0
    assert line_dedup(df.limit(0)).count() == 0
    assert line_dedup(df.selectExpr("doc_id", "CAST(NULL AS STRING) AS text")).filter("n_lines = 0").count() == 2


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    plan = line_dedup(df)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_a_long_line_is_a_run(spark):
    rng = random.Random(7)
    lines = [" ".join(f"w{k}-{j}" for j in range(n)) for k, n in enumerate((1, 2, 5, 6, 7, 60))] + ["", " a  b\tc d e\t", " a  b\tc d e f "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 7)))) for i in range(60)]
    rows += [(100 + i, f"own {i}\n{lines[5]}\nelse {i}") for i in range(3)] + [(200 + i, f"own {i}\n{lines[2]}\nother {i}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for words in (5, 50):
        got = sorted(((r.doc_id, r.text, list(r.removed)) for r in line_dedup(df, long_words=words).collect()), key=str)
        assert got == _brute(rows, 2, words)
        removed = {i: g for i, _, g in got}
        assert removed[102] == [1] and removed[202] == []


def test_no_repeated_long_line_stays(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    kept = line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    lines = [x.strip(" \t\r") for r in kept for x in (r.text or "").split("\n")]
    long = [x for x in lines if len(x.split()) > 50]
    assert len(long) == len(set(long)) > 0


def test_only_selected_places_are_written(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(f"{rng.random()}" for _ in range(200))) for i in range(20)]
    units = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "1L AS body", "split(text, '\n') AS units", "transform(split(text, '\n'), x -> xxhash64(x)) AS hashes", "200 AS n")
    for window, most in ((2, 0.7), (5, 0.4), (9, 0.25)):  # 2 / (window + 1) of the lines
        places = _places(units, window, 50)
        assert places.count() < most * 4000
        assert places.selectExpr("sum(length(windows)) / 18 AS n").first().n == 20 * (201 - window)  # and no window is lost


def test_a_very_long_text(spark):
    body = "\n".join(f"line {k}" for k in range(60_000))
    df = spark.createDataFrame([(1, "line 3\nline 4"), (2, body)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup(df).collect()}
    assert got[2].n_lines == 60_000 and list(got[2].removed) == [3, 4] and got[1].n_removed == 0
