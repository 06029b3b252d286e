import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from argent.llm.importance import TABLE, hashes, importance_resample, op11_importance

SF = "/root/testdata/sf0.001"
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = WORDS.findall(data)
    return len(words), [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def _brute(docs, target):
    """Rows of (doc_id, n_features, weight, score, rank) by plain loops."""
    raw, aim = Counter(), Counter()
    for _, t in docs:
        raw.update(crc32(f) % 10000 for f in _features(t)[1])
    for t in target:
        aim.update(crc32(f) % 10000 for f in _features(t)[1])
    s_all, t_all = sum(raw.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10000) / ((raw[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    out, able = [], []
    for i, t in docs:
        n, features = _features(t)
        w = sum(gain[crc32(f) % 10000] for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(features), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=repr)


def test_table_agrees_with_the_pattern():
    for b in range(256):
        assert (TABLE[b] != 0x20) == bool(WORDS.match(bytes([b]).lower()))
    assert TABLE[ord("Q")] == ord("q") and TABLE[0xC3] == 0xC3


@pytest.mark.parametrize("size", [1, 7, 40, 1 << 20])
def test_pieces_change_nothing(size):
    rng = random.Random(3)
    for k in range(40):
        text = "".join(rng.choice(["Ab", "ç漢", " ", "  ", ".", "9", "\n", "x"]) for _ in range(rng.randrange(60)))
        n, want = _features(text)
        got = list(hashes(text.encode(), 3, size))
        assert sum(g[0] for g in got) == n
        assert Counter(h for _, grams in got for g in grams for h in g) == Counter(map(crc32, want))


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, score string, rank int")


def _got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_against_brute_force_on_awkward_rows(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ünï", "漢字", "A.B", "0x1F"]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for k in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " .\x00\n"), (None, rows[7][1]), (None, rows[7][1]), (1003, "long " * 300_000)]
    rows += [(2000, rows[9][1])] * 200  # a hot row: equal id, equal text, equal score
    target = ["w1 w2 w3 w4", None, "", "w1 w2 ünï"]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert _got(importance_resample(_docs(spark, rows).repartition(5), aim)) == _brute(rows, target)


def test_empty_tables(spark):
    none = _docs(spark, [])
    aim = spark.createDataFrame([("w1 w2",)], "text string")
    assert _got(importance_resample(none, aim)) == []
    rows = [(1, "a b " * 20), (2, "c")]
    assert _got(importance_resample(_docs(spark, rows), aim.limit(0))) == _brute(rows, [])


def test_the_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert _got(op11_importance(spark, SF)) == _brute(docs, target)


def test_the_draw_prefers_the_target(spark):
    rows = [(k, ("red green blue " if k % 10 == 0 else "one two three ") * 8) for k in range(400)]
    aim = spark.createDataFrame([("red green blue red green",)], "text string")
    drawn = importance_resample(_docs(spark, rows), aim).filter("rank is not null")
    assert drawn.count() == 20 and drawn.filter(F.col("doc_id") % 10 != 0).count() == 0
