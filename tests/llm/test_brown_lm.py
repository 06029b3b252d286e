import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from argent.llm import brown_lm
from argent.llm.brown_lm import exchange, fit_classes, held_out, op10_brown_lm, score_texts, tokens

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def _words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [*WORD.findall(low), None]


def test_tokens():
    for t in ("", " A\x0bb\x0c  É é\x1cx\n", "漢 字 Ab\r"):
        assert [w.decode() or None for w in tokens(t)] == _words(t)


def _base(rows):
    train = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in _words(t))
    n, v = sum(train.values()), len(train)
    return n, lambda t: (len(_words(t)), sum(train[w] > 0 for w in _words(t)), math.fsum(math.log10((train[w] + 1) / (n + v + 1)) for w in _words(t)))


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, base = _base([(r.doc_id, r.text) for r in docs.collect()])
    want = {r.doc_id: base(r.text) for r in docs.collect()}
    got = op10_brown_lm(spark, SF).collect()
    assert len(got) == len(want) and {r.train_tokens for r in got} == {n}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2]
        assert math.isclose(r.base_score, want[r.doc_id][2], rel_tol=1e-9)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_all_words_by_join_or_by_list_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    res = []
    for listed in (150_000, 900):
        model, counts = fit_classes(docs.filter(~held_out()), core_words=100, class_words=800, listed_words=listed)
        res.append({r.doc_id: r for r in score_texts(docs, model, counts).collect()})
    for i, r in res[0].items():
        s = res[1][i]
        assert r.n_known == s.n_known and math.isclose(r.base_score, s.base_score, rel_tol=1e-9) and math.isclose(r.score, s.score, rel_tol=1e-9)


def test_exchange_finds_alternating_classes():
    rng = random.Random(1)
    pairs = np.zeros((12, 12))
    for _ in range(20_000):  # words 0 to 4 before 5 to 9, and back
        pairs[rng.randrange(5), 5 + rng.randrange(5)] += 1
        pairs[5 + rng.randrange(5), rng.randrange(5)] += 1
    of = exchange(pairs, 10, 2)
    assert len(set(of[:5])) == 1 and len(set(of[5:10])) == 1 and of[0] != of[5] and list(of[10:]) == [2, 3]


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, "b a d d d"), (3, "e f")], "doc_id long, text string")
    model, counts = fit_classes(df, core_words=3, class_words=4, classes=2)
    assert np.allclose((10.0**model.transition).sum(1), 1)
    k = model.open
    named = sum(n / model.sizes[c] for w, (c, n) in model.listed.items() if c < k)
    assert math.isclose(named, k)
    rest = sum(10 ** model.open_emission(n) for c, n in model.listed.values() if c == k) + 10 ** model.open_emission(0)
    assert math.isclose(rest, 1)


def test_nulls_repeats_empty(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a a b", "y"), (3, "a a b", "z"), (3, "a a b", "z"), (4, "q" * 200_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    model, counts = fit_classes(df.filter(~held_out()))
    got = score_texts(df, model, counts).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 4), (1, 1), (2, 1), (3, 4), (3, 4), (4, 2)]
    assert score_texts(df.limit(0), model, counts).count() == 0
    model, counts = fit_classes(df.limit(0))
    got = {r.doc_id: r for r in score_texts(df, model, counts).collect()}
    assert model.train_tokens == 0 and got[1].base_score == 0.0 and got[3].n_known == 0
    assert brown_lm.END == b"" and df.select(F.col("text")).count() == 6


def test_every_training_word_has_a_class(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40)
    train = Counter(w for r in docs.collect() for w in tokens(r.text or ""))
    for listed in (150, 150_000):
        model, rest = fit_classes(docs, core_words=50, class_words=100, listed_words=listed, classes=8)
        of = {bytes(r["word"]): (r["class"], r["n"]) for r in rest.collect()}
        assert len(of) == len(train) - 101 and of.keys() | model.listed.keys() == train.keys()
        assert all(of.get(w, g) == g for w, g in model.listed.items()) and len(model.listed) == min(listed + 1, len(train))
        of |= model.listed
        assert all(n == train[w] and c != model.open for w, (c, n) in of.items())
        size = Counter()
        for c, n in of.values():
            size[c] += n
        assert [size[c] for c in range(10)] == model.sizes.tolist() and np.allclose((10.0**model.transition).sum(1), 1)

        docs2 = docs.unionAll(spark.createDataFrame([(-1, "nie gesehen nie qqq x")], docs.schema))
        for r, d in zip(sorted(score_texts(docs2, model, rest).collect()), sorted((d.doc_id, d.text) for d in docs2.collect())):
            at, want = model.open + 1, 0.0
            for w in tokens(d[1] or ""):
                c, n = of.get(w, (model.open, 1))
                want += model.transition[at, c] + (math.log10(n / model.sizes[c]) if c != model.open else 0.0)
                at = c
            assert r.doc_id == d[0] and math.isclose(r.score, want, rel_tol=1e-9)


def test_rare_words_join_the_class_of_their_contexts(spark):
    rows = [(i, "a x b y " * 40 + f"a left{i} b right{i} a x b y") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for listed in (4, 40, 1000):
        model, rest = fit_classes(df, core_words=4, class_words=4, listed_words=listed, classes=4)
        of = {r["word"].decode(): r["class"] for r in rest.collect()}
        c = {w.decode(): g[0] for w, g in model.listed.items()}
        assert len(of) == 60 and len({c["a"], c["b"], c["x"], c["y"]}) == 4
        assert {of[f"left{i}"] for i in range(30)} == {c["x"]} and {of[f"right{i}"] for i in range(30)} == {c["y"]}
