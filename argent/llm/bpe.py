"""Operator 2, BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over each text's bytes cuts it into chunks whose borders depend
on content alone, so copies of a passage share chunks wherever they stand.

1. One scan counts the 128-bit hashes of all chunks; the repeated ones are
   kept as a bitmap of fixed size.
2. A second scan encodes each text that has no repeated chunk on the spot.
   Other texts become recipes: chunks of their own are encoded there, repeated
   chunks are named by hash, and each distinct repeated chunk is encoded once.
3. The joins of chunks are repaired: around each cut the text is encoded anew
   from the last certain token border before it to the first one after it. A
   certain border stands between a visible ASCII character and white space: the
   pre-tokenizer's pattern has no match that spans it, so both neighbours agree
   with the encoding of the whole text there. A chunk without such a border is
   swallowed by the repair of its neighbours, however long that grows, and the
   borders are checked against the chunk's own tokens; a text in which one is
   missing is encoded whole.
4. Recipes are joined with the chunk encodings and decoded again.

Recipes are keyed by a hash of the whole text, so equal texts are worked once.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import bitmap, load, staged, texts

CUT_BITS = 10  # a cut every 1,024 bytes on average
MIN_CHUNK, MAX_CHUNK = 256, 8192
SHARED_BITS = 23  # bitmap of repeated chunks: 1 MiB
END = "<|endoftext|>"
END_ID = 50256
WS = np.zeros(256, bool)
WS[[9, 10, 13, 32]] = True
VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7F] = True
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """The byte-level vocabulary, with the tables the operator needs."""

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding(
            "byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END: END_ID}
        )
        size = max(max(ranks.values()), END_ID) + 1
        self.n_bytes = np.zeros(size, np.int64)
        for token, i in ranks.items():
            self.n_bytes[i] = len(token)
        self.n_bytes[END_ID] = len(END)
        self.names = [str(i) for i in range(size)]

    def encode(self, data: bytes) -> np.ndarray:
        text = data.decode("utf-8")
        return np.array(self.enc.encode(text, allowed_special="all"), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.enc.decode_bytes(ids.tolist())


@functools.lru_cache(maxsize=2)
def _codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def cuts(data: bytes) -> list[int]:
    """Chunk borders of one text, 0 and its length included."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [0, n] if n else [0]
    b = np.frombuffer(data, np.uint8)
    h = _GEAR[b]
    for k in (1, 2, 4, 8, 16):  # hash of the last 32 bytes
        s = h.copy()
        s[k:] += h[:-k] << np.uint32(k)
        h = s
    start = np.append((b[1:] & 0xC0) != 0x80, True)  # the next byte begins a character
    at = np.flatnonzero((h >> np.uint32(32 - CUT_BITS) == 0) & start) + 1
    out = [0]
    for p in [*at.tolist(), n]:
        while p - out[-1] > MAX_CHUNK:
            q = out[-1] + MAX_CHUNK
            while not start[q - 1]:
                q -= 1
            out.append(q)
        if p - out[-1] >= MIN_CHUNK and p < n:
            out.append(p)
    if out[-1] < n:
        out.append(n)
    return out


def cores(data: bytes, at: list[int]) -> list[tuple[int, int]]:
    """For each chunk, the part between its first and last certain borders."""
    b = np.frombuffer(data, np.uint8)
    hard = np.flatnonzero(WS[b[1:]] & VISIBLE[b[:-1]]) + 1 if len(b) else np.empty(0, np.int64)
    n, out = len(data), []
    lo = hard[np.minimum(np.searchsorted(hard, at[:-1]), max(len(hard) - 1, 0))] if len(hard) else None
    hi = hard[np.maximum(np.searchsorted(hard, at[1:], side="right") - 1, 0)] if len(hard) else None
    for i, (a, z) in enumerate(zip(at, at[1:])):
        left = a if a == 0 else (int(lo[i]) if lo is not None and a <= lo[i] else z)
        right = z if z == n else (int(hi[i]) if hi is not None and hi[i] <= z else a)
        out.append((left, right) if a <= left < right <= z else (a, a))
    return out


def part(ids: np.ndarray, codec: Codec, lo: int, hi: int) -> np.ndarray | None:
    """The tokens of bytes lo to hi; None if these are not token borders."""
    ends = np.concatenate([[0], np.cumsum(codec.n_bytes[ids])])
    i, j = np.searchsorted(ends, [lo, hi])
    if j >= len(ends) or ends[i] != lo or ends[j] != hi:
        return None
    return ids[i:j]


def recipe(data: bytes, codec: Codec, shared) -> list[tuple[bytes | None, int, int, np.ndarray | None]] | None:
    """(chunk hash, from, to, None) or (None, 0, 0, ids) pieces of one text;
    None if a border fails its check, so that the text is encoded whole."""
    at = cuts(data)
    pieces, done = [], 0
    for (a, z), (lo, hi) in zip(zip(at, at[1:]), cores(data, at)):
        if lo == hi:
            continue
        if done < lo:
            pieces.append((None, 0, 0, codec.encode(data[done:lo])))
        key = shared(data[a:z])
        own = None
        if key is None:
            own = part(codec.encode(data[a:z]), codec, lo - a, hi - a)
            if own is None:
                return None
        pieces.append((key, lo - a, hi - a, own))
        done = hi
    if done < len(data):
        pieces.append((None, 0, 0, codec.encode(data[done:])))
    return pieces


def _digest(ids: np.ndarray, codec: Codec) -> tuple:
    names = codec.names
    text = ",".join([names[i] for i in ids.tolist()])
    return (
        len(ids),
        hashlib.sha256(text.encode()).hexdigest(),
        hashlib.sha256(codec.decode(ids)).hexdigest(),
    )


def _full(ids: np.ndarray, codec: Codec) -> tuple:
    return len(ids), ids.astype(np.int32), codec.decode(ids).decode("utf-8", "replace")


# What a finished text returns: digests, or the tokens and text themselves.
OUTPUTS = {
    "digest": (_digest, [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]),
    "full": (_full, [("n_tokens", "long", pa.int64()), ("ids", "array<int>", pa.list_(pa.int32())), ("decoded", "string", pa.string())]),
}


def _slot(key: bytes) -> int:
    return int.from_bytes(key[:8], "big", signed=True)


def _chunk_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[bytes, int] = {}
        for t in batch.column(0):
            data = t.as_py().encode()
            at = cuts(data)
            for a, z in zip(at, at[1:]):
                key = xxhash.xxh3_128_digest(data[a:z])
                seen[key] = seen.get(key, 0) + 1
        yield pa.record_batch(
            [pa.array(list(seen), pa.binary()), pa.array(list(map(_slot, seen)), pa.int64()), pa.array(list(seen.values()), pa.int64())],
            ["chunk", "slot", "n"],
        )


def _work(vocabulary: str, words, bits: int, output: str):
    finish, fields = OUTPUTS[output]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, table = _codec(vocabulary), words.value
        size = 1 << bits

        def shared(chunk: bytes) -> bytes | None:
            key = xxhash.xxh3_128_digest(chunk)
            slot = _slot(key) % size
            if int(table[slot >> 6]) >> (slot & 63) & 1:
                found[key] = chunk
                return key
            return None

        for batch in batches:
            rows = []
            found: dict[bytes, bytes] = {}
            worked: dict[bytes, tuple | None] = {}  # of this batch, by text
            for i, t in zip(batch.column(0), batch.column(1)):
                data = t.as_py().encode()
                whole = xxhash.xxh3_128_digest(data)
                if whole not in worked:
                    pieces = recipe(data, codec, shared)
                    if pieces is None:
                        pieces = [(None, 0, 0, codec.encode(data))]
                    if any(p[0] for p in pieces):
                        worked[whole] = None
                        for seq, (key, lo, hi, ids) in enumerate(pieces):
                            rows.append({"kind": "piece", "text": whole, "seq": seq, "chunk": key, "lo": lo, "hi": hi, "data": None if ids is None else ids.tobytes()})
                    else:
                        ids = np.concatenate([p[3] for p in pieces]) if pieces else np.empty(0, np.uint32)
                        worked[whole] = finish(ids, codec)
                row = {"kind": "doc", "doc_id": i.as_py(), "text": whole}
                if (done := worked[whole]) is not None:
                    row |= {"kind": "done"} | {f[0]: v for f, v in zip(fields, done)}
                rows.append(row)
            rows += [{"kind": "chunk", "chunk": k, "data": v} for k, v in found.items()]
            types = [("kind", pa.string()), ("doc_id", batch.schema.field(0).type), ("text", pa.binary()), ("seq", pa.int32()), ("chunk", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("data", pa.binary())]
            types += [(f[0], f[2]) for f in fields]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(types))

    return run


def _encode_chunks(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            ids = [codec.encode(x.as_py()).tobytes() for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], ["chunk", "ids"])

    return run


def _assemble(vocabulary: str, output: str):
    finish, fields = OUTPUTS[output]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            out = []
            for pieces in batch.column(1):
                got = []
                for p in sorted(pieces.as_py(), key=lambda p: p["seq"]):
                    if p["ids"] is None:
                        got.append(np.frombuffer(p["data"], np.uint32))
                        continue
                    ids = part(np.frombuffer(p["ids"], np.uint32), codec, p["lo"], p["hi"])
                    if ids is None:
                        raise ValueError("a certain border is missing in a chunk's tokens")
                    got.append(ids)
                out.append(finish(np.concatenate(got), codec))
            cols = [pa.array([o[k] for o in out], f[2]) for k, f in enumerate(fields)]
            yield pa.record_batch([batch.column(0), *cols], ["text", *(f[0] for f in fields)])

    return run


def bpe_round_trip(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    output: str = "digest",
    shared_bits: int = SHARED_BITS,
) -> DataFrame:
    """Encode every whole text and decode the ids again; one row per row.

    ``output="full"`` returns n_tokens, ids (array<int>) and decoded;
    ``"digest"`` n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256. Special-token strings in a text become that token, as the
    tokenizers library does by default. A null text is the empty text, which
    has no tokens. Rows that repeat (also with null or repeated doc_id) are
    each answered; an empty table gives an empty result. ``vocabulary`` is the
    path of the rank file on every node; by default the installed one.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or _public("byte_bpe_50k.tiktoken")
    base = texts(docs, id_col, text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()

    counted = base.select("text").mapInArrow(_chunk_counts, "chunk binary, slot long, n long")
    repeated = counted.groupBy("chunk", "slot").agg(F.sum("n").alias("n")).filter("n > 1")
    words = np.array(bitmap(repeated, "slot", shared_bits), dtype=np.int64).view(np.uint64)
    words = spark.sparkContext.broadcast(words)

    fields = OUTPUTS[output][1]
    schema = f"kind string, doc_id {id_type}, text binary, seq int, chunk binary, lo int, hi int, data binary, " + ", ".join(f"{f[0]} {f[1]}" for f in fields)
    work = staged(base.mapInArrow(_work(vocabulary, words, shared_bits, output), schema), "op2-work")
    names = [f[0] for f in fields]

    chunks = (
        work.filter("kind = 'chunk'").select("chunk", "data").dropDuplicates(["chunk"])
        .mapInArrow(_encode_chunks(vocabulary), "chunk binary, ids binary")
    )
    chunks = staged(chunks, "op2-chunks")  # so that the join reads plain exchanges
    pieces = work.filter("kind = 'piece'").dropDuplicates(["text", "seq"]).select("text", "seq", "chunk", "lo", "hi", "data")
    joined = (
        pieces.filter("chunk IS NOT NULL").join(chunks, "chunk")
        .select("text", F.struct("seq", "lo", "hi", "data", "ids").alias("p"))
        .unionByName(
            pieces.filter("chunk IS NULL").select(
                "text", F.struct("seq", "lo", "hi", "data", F.lit(None).cast("binary").alias("ids")).alias("p")
            )
        )
    )
    built = (
        joined.groupBy("text").agg(F.collect_list("p").alias("pieces"))  # one text's pieces
        .mapInArrow(_assemble(vocabulary, output), "text binary, " + ", ".join(f"{f[0]} {f[1]}" for f in fields))
    )
    built = staged(built, "op2-texts")
    done = work.filter("kind = 'done'").select("doc_id", *names)
    return done.unionByName(
        work.filter("kind = 'doc'").select("doc_id", "text").join(built, "text").select("doc_id", *names)
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(load(spark, sf_dir, "documents"))
