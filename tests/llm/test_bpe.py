import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from argent.llm import bpe
from argent.llm.bpe import bpe_round_trip


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _awkward() -> list:
    rng = random.Random(5)
    words = ["the", "it's", "don't", "naïve", "…", " ", "　", "漢字", "🙂", "x" * 40, "12345", "<|endoftext|>", "\r\n", "\t", "--", "'s", "<|endof", "text|>"]
    passage = " ".join(rng.choice(words) for _ in range(900))
    many = ["".join(rng.choice(words) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randint(1, 1500))) for _ in range(30)]
    return [None, "", " ", "\n\n", passage, passage, "pre " + passage, passage + "tail", passage[7:] + passage,
            "z" * 60000, "漢" * 9000, "🙂" * 5000, " " * 20000, "ab" * 8000 + passage, "a b" * 20000, *many]


def test_equals_the_tokenizers_library(spark, tok):
    texts = _awkward()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for bits in (bpe.SHARED_BITS, 6):  # 6: nearly every chunk counts as shared
        got = {r.doc_id: r for r in bpe_round_trip(df, shared_bits=bits).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            ids = tok.encode(t or "", add_special_tokens=False).ids
            assert got[i].n_tokens == len(ids)
            assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            back = tok.decode(ids, skip_special_tokens=False)
            assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_repeated_rows_null_ids_extra_columns(spark):
    rows = [(1, "same text " * 300, "x")] * 3 + [(None, "same text " * 300, "y"), (2, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string")
    got = bpe_round_trip(df, output="full").collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 1, 2]
    assert {r.decoded for r in got if r.doc_id != 2} == {"same text " * 300}
    assert [r.n_tokens for r in got if r.doc_id == 2] == [0]
    assert bpe_round_trip(df.limit(0)).count() == 0


def test_shared_chunks_are_found_at_any_offset():
    rng = random.Random(1)
    body = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(5000)).encode()
    def chunks(d):
        at = bpe.cuts(d)
        assert b"".join(d[a:z] for a, z in zip(at, at[1:])) == d
        return {d[a:z] for a, z in zip(at, at[1:])}
    a, b = chunks(body), chunks(b"some other beginning " + body)
    assert len(a & b) > 0.8 * len(a)
