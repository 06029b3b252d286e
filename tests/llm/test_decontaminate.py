import itertools
import random
import re

from argent.llm.decontaminate import MASKS, STRETCH, SUBSTITUTIONS, find_contamination


def _words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def _brute(text, item):
    d, b = _words(text), _words(item)
    need = min(len(b), STRETCH)
    if len(b) < 5:
        return False
    allowed = SUBSTITUTIONS if len(b) >= STRETCH else 0
    return any(
        sum(x == y for x, y in zip(d[i : i + need], b[j : j + need])) >= need - allowed
        for i in range(len(d) - need + 1) for j in range(len(b) - need + 1)
    )


def test_masks_miss_no_case():
    for gone in itertools.chain(*(itertools.combinations(range(STRETCH), k) for k in range(SUBSTITUTIONS + 1))):
        assert any(not {s + o for o in m} & set(gone) for m in MASKS for s in range(STRETCH - m[-1]))


def _tables(spark, rows, items):
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, item string").repartition(4)
    return docs, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n int")


def test_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(40)] + ["été", "漢字"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(text(n))) for k, n in enumerate((36, 36, 20, 13, 13, 12, 9, 5, 4, 30))]
    items += [(20, items[0][1].upper() + "!"), (21, None), (22, "")]
    rows = []
    for i in range(150):
        words = text(rng.randint(0, 60))
        item = _words(rng.choice(items)[1])
        if item and i % 3:
            a = rng.randrange(len(item))
            piece = [x if rng.random() > 0.12 else "other" for x in item[a : a + rng.randint(5, 40)]]
            at = rng.randrange(len(words) + 1)
            words[at:at] = piece
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    rows += [(500, None), (501, ""), (None, rows[1][1]), rows[2], rows[2], (502, "w1 " * 20_000 + items[1][1])]
    docs, bench = _tables(spark, rows, items)
    for block in (500_000, 60):
        got = find_contamination(docs, bench, block_seeds=block).collect()
        want = sorted(((i, [k for k, b in items if _brute(t, b)]) for i, t in rows), key=str)
        assert sorted(((r.doc_id, list(r.item_ids)) for r in got), key=str) == want
        assert all(r.contaminated == bool(r.item_ids) for r in got)
    assert sum(bool(w[1]) for w in want) > 20


def test_empty_sides_and_plan(spark):
    docs, bench = _tables(spark, [(1, "a b c d e f g")], [(1, "a b c d e f g")])
    assert [r.contaminated for r in find_contamination(docs, bench).collect()] == [True]
    assert [r.contaminated for r in find_contamination(docs, bench.limit(0)).collect()] == [False]
    assert find_contamination(docs.limit(0), bench).count() == 0
    plan = find_contamination(docs, bench)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
