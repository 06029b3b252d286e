"""The queries with SQL against it, and the contract columns of all of them."""

import duckdb
import pytest

import __spark_entry__ as entry
from argent.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_decontaminate": {"doc_id": "bigint", "contaminated": "boolean", "n_items": "bigint", "item_ids": "string"},
    "op2_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op4_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op5_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op6_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op9_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op10_brown_lm": {
        "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"
    },
    "op11_importance": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    "op12_packing": {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint", "source": "string"
    },
    "op13_whitening": {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"
    },
}


def test_registry():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLES) <= set(QUERIES)
    assert set(entry.queries()) >= set(QUERIES) | {"pipeline"} and set(entry.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_columns_and_sql(spark, key):
    df = QUERIES[key](spark, SF)
    assert dict(df.dtypes) == COLUMNS[key]
    table, each = {"op4_url_filter": ("pages", 1), "op13_whitening": ("embeddings", 4)}.get(key, ("documents", 1))
    if key not in ORACLES:
        if key == "op12_packing":  # a row per piece
            df = df.select("doc_id").distinct()
        assert df.count() == each * spark.read.parquet(f"{SF}/{table}.parquet").count()
        return
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[key])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
