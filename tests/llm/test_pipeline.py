import hashlib

import public_tokenizers
from test_decontaminate import _brute as contaminated
from test_jaccard_join import _brute as near
from test_line_dedup import _brute as deduped
from tokenizers import Tokenizer

import corpus_pipeline as P
from argent.llm.toxicity import features, held_out, query_model

SF = "/root/testdata/sf0.001"


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    outs, now = [], docs
    for _, stage in P.STAGES:
        now = P.staged(stage(spark, now, SF), "test-stage")
        outs.append(now)
    assert all(o.schema.simpleString() == docs.schema.simpleString() for o in outs[:-1])
    clean, lines, near_, decon, encoded = map(_rows, outs)

    before = _rows(docs)
    labels = _rows(spark.read.parquet(f"{SF}/labels.parquet"))
    kept_clean = [i in clean for i, r in labels.items() if r.toxic == 0]
    assert set(clean) <= set(before) and all(clean[i] == before[i] for i in clean)
    assert sum(kept_clean) >= 0.95 * len(kept_clean)

    want = {i: t for i, t, _ in deduped([(i, r.text) for i, r in clean.items()], 2)}
    assert {i: r.text for i, r in lines.items()} == want
    assert all(r.n_chars == len(r.text) and r.source == before[i].source for i, r in lines.items())

    groups = {i: c for i, _, c in near([(i, r.text) for i, r in lines.items()], 5, 8, 10)}
    assert set(near_) == {i for i, c in groups.items() if i == c} and len(near_) < len(lines)

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(decon) == {i for i, r in near_.items() if not any(contaminated(r.text, b) for b in items)}

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert set(encoded) == set(decon)
    for i, r in encoded.items():
        ids = tok.encode(decon[i].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decon[i].text.encode()).hexdigest()


def test_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, removed int"
    rows = [(1, None, "en", None, None, "r", 1), (2, "", None, "s", 0, "r", 1), (None, "a b c d e f", "x", "s", 3, None, None), (3, "a b c d e f", "x", "s", 11, "r", 2)]
    rows += [rows[3], (3, "another text\nanother text\nanother text", "y", "s", 1, "q", 0), (4, "w " * 60_000, "y", "s", 1, "q", 0)]
    docs = spark.createDataFrame(rows, schema)
    # Toxicity learns from sf_dir's labels and the documents there.
    model = query_model(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    now = P.staged(P.drop_toxic(docs, model), "test-awkward")
    assert sorted(map(repr, now.collect())) == sorted(map(repr, docs.collect()))  # none is toxic
    assert P.toxicity(spark, docs, SF).columns == docs.columns
    for name, stage in P.STAGES[1:]:
        now = P.staged(stage(spark, now, SF), "test-awkward")
        if name == "n-gram Jaccard join":
            assert sorted((r.doc_id or 0, r.text or "") for r in now.collect())[:4] == [(1, ""), (2, ""), (3, "a b c d e f"), (3, "another text")]
    assert now.count() == 5
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_toxic_rows_go(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = query_model(spark, docs, sf)
    memory = model.gains()
    want = {r.doc_id for r in docs.collect() if model.score(features(r.text or "", memory)) < 0.5}
    assert {r.doc_id for r in P.toxicity(spark, docs, sf).collect()} == want

    labels = spark.read.parquet(f"{sf}/labels.parquet").filter(held_out()).collect()
    toxic, clean = ({r.doc_id for r in labels if r.toxic == t} for t in (1, 0))
    assert toxic and len(toxic - want) >= 0.95 * len(toxic) and len(clean & want) >= 0.95 * len(clean)
