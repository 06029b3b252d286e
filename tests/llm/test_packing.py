import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from argent.llm.bpe import _codec
from argent.llm.packing import apportion, encode, op12_packing, pack, phases, rounds, sequences

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation(), t.no_padding()
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_the_tokens_are_those_of_the_library(tokenizer):
    rng = random.Random(2)
    parts = ["a", "Don't", "'s", " ", "  ", "\n", "\t ", "\xa0", "\u3000", "\x1c", "\x0b", "\x85", "漢字", "é", "!!", "9", "<|endoftext|>", "\u200b", "\x00", "word", "ﬀ"]
    codec = _codec(VOCABULARY)
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert np.frombuffer(encode(text, codec), "<u4").tolist() == tokenizer(text)[:-1], repr(text)


def test_apportion():
    rng = random.Random(4)
    for _ in range(500):
        most = [rng.randrange(0, 50) for _ in range(rng.randrange(1, 8))]
        total = rng.randint(0, sum(most))
        out = apportion([rng.randrange(0, 9) for _ in most], total, most)
        assert sum(out) == total and all(0 <= a <= m for a, m in zip(out, most))
    assert apportion([1, 1, 2], 100, [99, 99, 99]) == [25, 25, 50]


def test_rounds_keep_the_proportions_and_carry_deficits():
    amounts = [30_000, 20_000, 15_000, 500, 36]
    turns = rounds(amounts, 1024, 32)
    got = Counter()
    for w, window in enumerate(turns):
        assert sum(n for _, n in window) == min(1024, sum(amounts) - 1024 * w)
        for k, n in window:
            got[k] += n
        for k, a in enumerate(amounts):  # never far from the share, however many windows
            assert abs(got[k] - 1024 * (w + 1) * a / sum(amounts)) <= 64
    assert [got[k] for k in range(5)] == amounts


def _stream(tokens, weights=None, **options):
    """Every window's turns, one after the other, by walking the schedule."""
    out = []
    for p in phases(tokens, weights, **options):
        turns = sorted((int(x), k, int(n)) for k, f in enumerate(p.turns) for x, n in zip(f[1], f[2]))
        assert p.base == sum(n for _, n in out) and sum(n for _, _, n in turns) == p.length
        out += [(k, n) for _ in range(p.cycles) for _, k, n in turns]
    return out


def test_phases_empty_every_queue():
    rng = random.Random(6)
    for _ in range(25):
        tokens = [rng.choice([0, 1, 7, 3000, 100_000, 4_000_000]) for _ in range(rng.randrange(1, 7))]
        weights = rng.choice([None, [rng.randrange(5) for _ in tokens]])
        got = Counter()
        for k, n in _stream(tokens, weights):
            got[k] += n
        assert [got[k] for k in range(len(tokens))] == tokens
    assert len(phases([10**13 + 7, 3 * 10**12, 10**10 + 1, 1], None)) < 30


def _sources(pieces):
    """Of every sequence: its (source, tokens) in order, turns of one source merged."""
    out = defaultdict(list)
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        have = out[r.sequence_id]
        if have and have[-1][0] == r.source:
            have[-1] = (r.source, have[-1][1] + r.length)
        else:
            have.append((r.source, r.length))
    return out


def _holds(rows, pieces, tokenizer, window=1024):
    """What every packing must satisfy, against the tokenizers library."""
    want = Counter()
    for i, t, s in rows:
        ids = tokenizer(t)
        want[(i, s, len(ids), tuple(ids))] += 1
    by_doc = defaultdict(list)
    for r in pieces:
        by_doc[(r.doc_id, r.source, r.doc_tokens)].append(r)
    for (i, s, n), got in by_doc.items():
        wanted = [(ids, c) for (a, b, m, ids), c in want.items() if (a, b, m) == (i, s, n)]
        assert sum(r.length for r in got) == n * sum(c for _, c in wanted)
        places = Counter()
        for r in got:
            assert any(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for ids, _ in wanted)
            places.update(range(r.start, r.start + r.length))
        assert set(places.values()) == {sum(c for _, c in wanted)}
    assert set(by_doc) == {k[:3] for k in want}
    total, sizes = sum(r.length for r in pieces), defaultdict(list)
    for r in pieces:
        sizes[r.sequence_id].append((r.offset, r.length))
    for k, parts in sizes.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end and n > 0
            end += n
        assert end == min(window, total - k * window)
    assert sorted(sizes) == list(range(-(-total // window)))


def test_against_plain_rounds_on_awkward_rows(spark, tokenizer):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(["word", "Übung", "42", "漢字", "x."]) for _ in range(rng.randrange(120))), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(400)]
    rows += [(1000, None, "a"), (1001, "", "a"), (None, "null id", "b"), (1002, "only one", "rare"), (1003, "long text " * 60_000, "c"), (1004, "x<|endoftext|> y", "b")]
    rows += [(2000, "same row", "a")] * 150
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, ids int")
    for parts in (1, 6):
        pieces = pack(df.repartition(parts), output="crc").collect()
        _holds(rows, pieces, tokenizer)
        tokens = Counter()
        for _, t, s in rows:
            tokens[s] += len(tokenizer(t))
        total = sum(tokens.values())
        names = sorted((s for s, n in tokens.items() if n * 1024 >= total), key=lambda s: (s is None, s))
        want, at = defaultdict(Counter), 0
        for k, n in _stream([*(tokens[s] for s in names), total - sum(tokens[s] for s in names)]):
            want[at // 1024][names[k] if k < len(names) else "rare"] += n
            at += n
        got = _sources(pieces)
        assert {w: Counter(dict(v)) for w, v in got.items()} == dict(want)


def test_targets_hold_until_a_source_runs_dry(spark):
    text = "one two three four five six seven eight nine ten. " * 20
    rows = [(k, text, "ab"[k % 4 == 0]) for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = pack(df, targets={"a": 0.5}, output="crc", cycle=16).collect()
    got = _sources(pieces)
    dry = [w for w in got if len(got[w]) == 1]
    assert all(s == "a" for w in dry for s, _ in got[w])  # a is three times b
    for w in range(min(dry)):
        if w < min(dry) - 16:  # before the cycle in which b runs dry
            assert all(abs(n - 512) <= 64 for n in Counter(dict(got[w])).values())


def test_ids_and_sequences(spark, tokenizer):
    rows = [(k, f"text number {k} " * 30, "ab"[k % 2]) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = pack(df)
    for r in pieces.collect():
        assert r.ids == tokenizer(rows[r.doc_id][1])[r.start : r.start + r.length]
    got = sequences(pieces).collect()
    assert sorted(len(r.ids) for r in got)[1:] == [1024] * (len(got) - 1)
    assert Counter(x for r in got for x in r.ids) == Counter(x for r in rows for x in tokenizer(r[1]))


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_the_query(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    pieces = op12_packing(spark, SF).collect()
    _holds([(r.doc_id, r.text, r.source) for r in docs], pieces, tokenizer)
    tokens = Counter()
    for r in pieces:
        tokens[r.source] += r.length
    total, windows = sum(tokens.values()), _sources(pieces)
    for w, have in windows.items():
        if w < len(windows) - 1:
            have = Counter(dict(have))
            assert all(abs(have[s] - 1024 * n / total) <= 64 for s, n in tokens.items())
