"""Operator 9, suffix-array dedup by longest previous factors.

A byte is removed if a string of ``MIN_BYTES`` bytes that covers it also starts
in a document of smaller doc_id. A suffix array over all texts would need every
suffix in one order, so the suffixes are dealt out first, in a way that keeps
equal strings together:

1. Every window of MIN_BYTES bytes has an anchor, its GRAM-byte gram of smallest
   hash; equal windows have equal anchors. One scan collects the anchors, and
   those that occur in several rows are found by bucket of hash.
2. Rows with such anchors send, for each, the stretch of text that its windows
   cover to the anchor's bucket. Equal stretches are one there, known by their
   smallest doc_id; the others are removed at once.
3. In each bucket the suffixes that start the windows of the stretches left are
   sorted (the suffix array), with the common prefix lengths of neighbours. The
   previous and the next suffix in this order that belong to a smaller doc_id
   give each suffix its longest previous factor; where it reaches MIN_BYTES, the
   window is removed.

Only anchors, repeated stretches and the texts that have them are shuffled.
Buckets grow in number with the input. A passage in very many documents sends
each bucket one stretch per piece of rows, not one per document. Rows are
known to the buckets by their number in the piece; a piece writes the list of
its rows once, and what the buckets found is brought together by piece and
given its rows there. Pieces have the same rows in any rerun of a task: those of a
file's split, or sorted ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.llm.common import load, texts

MIN_BYTES, GRAM = 50, 20
SPAN = MIN_BYTES - GRAM + 1  # places of the gram in a window
BUCKET_BYTES = 10_000_000  # of text for each bucket
PIECE_BYTES = 4_000_000  # of text worked on at a time
BLOCK_BYTES = 1_000_000  # of text hashed at a time
SLICE_WINDOWS = 50_000  # sorted at a time, unless one anchor has more
NULL_ORDER = np.iinfo(np.int64).max  # a null doc_id comes last
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_B = np.uint64(0x9E3779B97F4A7C15)
_HASH = np.uint64((1 << 48) - 2)
_HALF = np.uint64((1 << 47) - 1)


def _pow(k: int) -> np.uint64:
    return np.uint64(pow(int(_B), k, 1 << 64))


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each ``width`` neighbours from i on."""
    have = 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def _spread(h: np.ndarray) -> np.ndarray:
    """Another hash of each anchor hash, different for different ones and even
    over the 48 bits: anchors are minima and lie close to 0."""
    x = (h >> np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) & _HALF
    x ^= x >> np.uint64(24)
    x = x * np.uint64(0xD6E8FEB86659FD93) & _HALF
    x ^= x >> np.uint64(24)
    return x << np.uint64(1)


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: anchor hashes, places, and the first and last
    window start that each anchors."""
    n = len(data)
    if n < MIN_BYTES:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    h1 = _TABLE[data]
    h2 = h1[:-1] * _B + h1[1:]
    h4 = h2[:-2] * _pow(2) + h2[2:]
    h8 = h4[:-4] * _pow(4) + h4[4:]
    h16 = h8[:-8] * _pow(8) + h8[8:]
    h = h16[: n - GRAM + 1] * _pow(4) + h4[16 : n - GRAM + 17]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h &= _HASH  # 48 bits pack smaller; a chance repeat only sends a stretch too many
    h += np.uint64(1)  # 0 marks windows that cross into the next text
    low = _slide(h, SPAN, np.minimum)  # of the window that starts here
    inside = np.ones(len(low), bool)
    for e in ends[:-1]:  # windows that would cross into the next text
        inside[max(0, e - MIN_BYTES + 1) : e] = False
    low[~inside] = 0
    padded = np.concatenate([np.zeros(SPAN - 1, np.uint64), low, np.zeros(SPAN - 1, np.uint64)])
    chosen = np.flatnonzero(_slide(padded, SPAN, np.maximum) == h[: len(low) + SPAN - 1])
    # Runs of windows with the same smallest hash.
    change = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (inside[1:] != inside[:-1])]))
    stop = np.append(change[1:], len(low))
    first = np.searchsorted(change, np.maximum(chosen - SPAN + 1, 0), side="right") - 1
    # Windows around a chosen place that have its hash: one run, but for ties.
    run = first.copy()
    for _ in range(SPAN):
        wrong = low[np.minimum(change[run], len(low) - 1)] != h[chosen]
        if not wrong.any():
            break
        run[wrong] = np.minimum(run[wrong] + 1, len(change) - 1)
    start = np.maximum(change[run], chosen - SPAN + 1)
    last = np.minimum(stop[run] - 1, chosen)
    good = (start <= last) & (low[np.minimum(start, len(low) - 1)] == h[chosen])
    return _spread(h[chosen[good]]), chosen[good], start[good], last[good]


def _blocks(datas: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about BLOCK_BYTES, and the index of the first."""
    at = first = size = 0
    for at, d in enumerate(datas):
        size += len(d)
        if size >= BLOCK_BYTES:
            yield first, datas[first : at + 1]
            first, size = at + 1, 0
    if first < len(datas):
        yield first, datas[first:]


def _anchored(datas: list[bytes], known: list[np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """anchors() of a batch: hash and index of the text; with ``known``, the
    hashes wanted of each text, only those, and their first and last window
    starts as well."""
    out = []
    for start, block in _blocks(datas):
        ends = np.cumsum([len(d) for d in block])
        h, _, a, z = anchors(np.frombuffer(b"".join(block), np.uint8), ends)
        of = np.searchsorted(ends, a, side="right")
        if known is None:
            out.append((h, (of + start).astype(np.int32)))
            continue
        edges = np.searchsorted(of, np.arange(len(block) + 1))
        keep = np.concatenate([np.isin(h[x:y], known[start + k]) for k, (x, y) in enumerate(zip(edges, edges[1:]))])
        base = (ends - [len(d) for d in block])[of]
        out.append((h[keep], of[keep] + start, (a - base)[keep], (z - base)[keep]))
    if out:
        return tuple(np.concatenate(x) for x in zip(*out))
    return np.empty(0, np.uint64), *(np.empty(0, np.int64),) * (1 if known is None else 3)


def _pack(x: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(dtype).ravel()


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about PIECE_BYTES of text, so that memory follows
    from that and not from the size of Arrow's batches."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + PIECE_BYTES, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _rows(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    datas = [t.as_py().encode() for t in batch.column(0)]
    return datas, batch.column(1).to_numpy(), batch.column(2).to_numpy()


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal values in sorted columns."""
    if not len(columns[0]):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]))
    return cut, np.append(cut[1:], len(columns[0]))


def _by_document(doc: np.ndarray, body: np.ndarray, *payload: np.ndarray) -> tuple[list, list, list]:
    """doc, body and the payload as one blob, sorted, of each document."""
    order = np.lexsort((payload[0], body, doc))
    doc, body = doc[order], body[order]
    rows = np.stack([p[order] for p in payload], 1)
    a, z = _runs(doc, body)
    return doc[a].tolist(), body[a].tolist(), [rows[x:y].tobytes() for x, y in zip(a.tolist(), z.tolist())]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The pieces of a task, with numbers that no other piece has."""
    task = TaskContext.get().partitionId() << 32
    for k, batch in enumerate(_pieces(batches)):
        yield task + k, batch


def _grouped(work, schema: list):
    """applyInArrow of ``work``, which gets the rows of one group and returns rows."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(work(table.to_pylist()), schema=pa.schema(schema))

    return run


def _by_piece(piece: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """The piece and its part of each column, for each piece."""
    order = np.argsort(piece, kind="stable")
    for a, z in zip(*_runs(piece[order])):
        yield int(piece[order[a]]), *(c[order[a:z]] for c in columns)


def _ddl(types: list) -> str:
    return ", ".join(f"{name} {dict(int32='int', int64='long').get(str(kind), str(kind))}" for name, kind in types)


_FOUND_TYPES = [("piece", pa.int64()), *((c, pa.binary()) for c in ("hashes", "of", "docs", "bodies"))]
_COLLECTED_TYPES = [("bucket", pa.int32()), *_FOUND_TYPES]


def _collect(buckets: int):
    """Anchors of a piece by bucket. Those of several rows of the piece are
    known to repeat: they go with the list of the piece's rows (a row with
    ``docs``, which any bucket passes on), and the bucket only learns that they
    exist (row number -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, batch in _numbered(batches):
            datas, docs, bodies = _rows(batch)
            h, of = _anchored(datas)
            order = np.lexsort((of, h))
            h, of = h[order], of[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])]) if len(h) else np.empty(0, bool)
            h, of = h[new], of[new]
            start = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, bool)
            group = np.cumsum(start) - 1
            many = np.bincount(group)[group] > 1 if len(h) else np.empty(0, bool)
            out = [{
                "bucket": piece % buckets, "piece": piece, "hashes": _pack(h[many]), "of": _pack(of[many].astype(np.int32)),
                "docs": _pack(docs), "bodies": _pack(bodies),
            }]
            of = np.where(many, -1, of)
            h, of = h[start], of[start].astype(np.int32)
            bucket = _bucket(h, buckets)  # grows with h
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(h) else []
            for a, z in zip(cut, [*cut[1:], len(h)]):
                out.append({"bucket": int(bucket[a]), "piece": piece, "hashes": _pack(np.diff(h[a:z], prepend=np.uint64(0))), "of": _pack(of[a:z])})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_COLLECTED_TYPES))

    return run


def _passed_on(bucket: list[dict]) -> list[dict]:
    """The lists of rows, of pieces that any bucket may have got."""
    return [{k: v for k, v in r.items() if k != "bucket"} for r in bucket if r["docs"] is not None and r["bodies"] is not None]


def _repeated(bucket: list[dict]) -> list[dict]:
    """Of one bucket's anchors those that occur in several rows, by piece."""
    parts = [(np.cumsum(_unpack(r["hashes"], np.uint64)), _unpack(r["of"], np.int32), r["piece"]) for r in bucket if r["docs"] is None]
    out = _passed_on(bucket)
    if not parts:
        return out
    h, of = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    piece = np.repeat([p[2] for p in parts], [len(p[0]) for p in parts])
    order = np.argsort(h, kind="stable")
    a, z = _runs(h[order])
    found = order[np.repeat(z - a > 1, z - a) & (of[order] >= 0)]
    return out + [{"piece": p, "hashes": _pack(x), "of": _pack(y)} for p, x, y in _by_piece(piece[found], h[found], of[found])]


def _anchors_of_rows(piece: list[dict]) -> list[dict]:
    """doc, body and repeated anchors of a piece's rows."""
    (ids,) = [r for r in piece if r["docs"] is not None]
    docs, bodies = _unpack(ids["docs"], np.int64), _unpack(ids["bodies"], np.int64)
    of = np.concatenate([_unpack(r["of"], np.int32) for r in piece])
    h = np.concatenate([_unpack(r["hashes"], np.uint64) for r in piece])
    return [{"doc": d, "body": b, "hashes": blob} for d, b, blob in zip(*_by_document(docs[of], bodies[of], h))]


_SPAN_TYPES = [("piece", pa.int64()), *((c, pa.binary()) for c in ("of", "spans", "docs", "bodies"))]
_STRETCH_TYPES = [("bucket", pa.int32()), *_SPAN_TYPES, *((c, pa.binary()) for c in ("stretches", "lengths", "hashes", "starts"))]


def _collapse(h: np.ndarray, lengths: np.ndarray, keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal stretches: those of the smallest doc (one, unless that doc
    repeats it), and the others. ``keys`` are 128-bit hashes of the bytes."""
    order = np.lexsort((doc, keys[:, 1], keys[:, 0], lengths, h))
    if not len(order):
        return order, order
    changed = [np.diff(x[order]) != 0 for x in (h, lengths, keys[:, 0], keys[:, 1])]
    start = np.concatenate([[True], np.logical_or.reduce(changed)])
    least = doc[order[start]][np.cumsum(start) - 1]
    larger = doc[order] > least
    return order[~larger], order[larger]


def _merged(doc: np.ndarray, body: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of the same document that follow or overlap as one span."""
    order = np.lexsort((first, body, doc))
    doc, body, first, last = doc[order], body[order], first[order], last[order]
    a, z = _runs(doc, body)
    apart = np.repeat(np.arange(len(a)), z - a) << 40  # no span reaches into the next document
    first, last = first + apart, np.maximum.accumulate(last + apart)
    new = np.concatenate([[True], first[1:] > last[:-1] + 1]) if len(first) else np.empty(0, bool)
    at = np.flatnonzero(new)
    end = last[np.append(at[1:], len(last)) - 1] if len(at) else last
    return doc[at], body[at], first[at] - apart[at], end - apart[at]


def _keys(stretches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, stretches)), np.uint64).reshape(-1, 2)


def _spans(of: np.ndarray, first: np.ndarray, last: np.ndarray) -> dict:
    return {"of": _pack(of.astype(np.int32)), "spans": _pack(np.concatenate([first, last]).astype(np.int64))}


def _stretch(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, batch in _numbered(batches):
            datas, docs, bodies = _rows(batch)
            known = [np.frombuffer(b"".join(blobs.as_py()), np.uint64) for blobs in batch.column(3)]
            h, of, first, last = _anchored(datas, known)
            texts_ = [datas[i][a : z + MIN_BYTES] for i, a, z in zip(of.tolist(), first.tolist(), last.tolist())]
            lengths = last - first + 1
            one, gone = _collapse(h, lengths, _keys(texts_), docs[of])
            _, row, *span = _merged(np.zeros(len(gone), np.int64), of[gone].astype(np.int64), first[gone], last[gone])
            # Any bucket passes these on.
            out = [{"bucket": piece % buckets, "piece": piece, "docs": _pack(docs), "bodies": _pack(bodies)} | _spans(row, *span)]
            one = one[np.argsort(h[one], kind="stable")]
            bucket = _bucket(h[one], buckets)
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(one) else []
            for a, z in zip(cut, [*cut[1:], len(one)]):
                k = one[a:z]
                out.append({
                    "bucket": int(bucket[a]), "piece": piece, "stretches": zstandard.compress(b"".join(texts_[i] for i in k.tolist()), 1),
                    "lengths": _pack(lengths[k].astype(np.uint8)), "hashes": _pack(h[k]), "starts": _pack(first[k].astype(np.int64)),
                    "docs": _pack(docs[of[k]]), "of": _pack(of[k].astype(np.int32)),
                })
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_STRETCH_TYPES))

    return run


def suffix_array(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``starts`` by their first MIN_BYTES bytes,
    and the length of each one's common prefix with the one before it."""
    words = []
    for k in [*range(0, MIN_BYTES - 7, 8), MIN_BYTES - 8]:
        at = starts + k
        w = np.zeros(len(starts), np.uint64)
        for j in range(8):
            w = w << np.uint64(8) | data[at + j]
        words.append(w)
    order = np.lexsort(words[::-1])
    lcp = np.zeros(len(starts), np.int64)
    same = np.ones(max(0, len(starts) - 1), bool)
    for k, w in zip([*range(0, MIN_BYTES - 7, 8), MIN_BYTES - 8], words):
        x = w[order][1:] ^ w[order][:-1]
        # Equal leading bytes of this word, found by halves.
        equal = np.full(len(x), 8, np.int64)
        equal[x != 0] = 0
        for j in range(1, 8):
            equal[(x != 0) & (x >> np.uint64(8 * (8 - j)) == 0)] = j
        lcp[1:] = np.where(same, np.maximum(lcp[1:], k + equal), lcp[1:])
        same &= x == 0
    return order, lcp


def previous_factor(rank: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factors, in suffix order: the longer of the common
    prefixes with the previous and with the next suffix of smaller rank (the
    order of the documents), found by following such links by leaps."""
    n = len(rank)
    best = np.zeros(n, np.int64)
    for step in (-1, 1):
        link = np.arange(n) + step
        reach = lcp.copy() if step < 0 else np.append(lcp[1:], 0)
        while True:
            on = np.flatnonzero((link >= 0) & (link < n) & (reach > 0))
            on = on[rank[link[on]] >= rank[on]]
            if not len(on):
                break
            to = link[on]
            # A link that has arrived at a smaller rank than its own may still
            # be too large for this one, and is then followed further.
            new_reach = np.minimum(reach[on], reach[to])
            new_link = np.where((to >= 0) & (to < n), link[to], to)
            reach[on], link[on] = new_reach, new_link
        ok = (link >= 0) & (link < n)
        best[ok] = np.maximum(best[ok], reach[ok])
    return best


def _slices(groups: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive whole groups of about SLICE_WINDOWS windows."""
    last = np.append(np.flatnonzero(np.diff(groups)) + 1, len(groups))
    total, start = np.cumsum(sizes), 0
    while start < len(groups):
        done = total[start - 1] if start else 0
        stop = last[min(np.searchsorted(total[last - 1], done + SLICE_WINDOWS), len(last) - 1)]
        yield slice(start, stop)
        start = stop


def _factors(bucket: list[dict]) -> list[dict]:
    """First and last starts of the removed windows of one bucket, by piece."""
    told, parts = [{c: r[c] for c, _ in _SPAN_TYPES} for r in _passed_on(bucket)], []
    for r in bucket:
        if r["bodies"] is None:
            data = zstandard.decompress(r["stretches"])
            lengths = _unpack(r["lengths"], np.uint8).astype(np.int64)
            ends = np.cumsum(lengths + MIN_BYTES - 1)
            texts_ = [data[e - n : e] for e, n in zip(ends.tolist(), (lengths + MIN_BYTES - 1).tolist())]
            packed = (_unpack(r[c], t) for c, t in (("hashes", np.uint64), ("starts", np.int64), ("docs", np.int64), ("of", np.int32)))
            parts.append((texts_, lengths, *packed, np.full(len(lengths), r["piece"])))
    if not parts:
        return told
    texts_ = [t for p in parts for t in p[0]]
    lengths, h, starts, docs, of, pieces = (np.concatenate([p[k] for p in parts]) for k in range(1, 7))
    del parts
    one, gone = _collapse(h, lengths, _keys(texts_), docs)
    who, at, to = [gone], [starts[gone]], [starts[gone] + lengths[gone] - 1]
    # Only stretches whose anchor has others can hold repeated windows.
    one = one[np.argsort(h[one], kind="stable")]
    group = np.cumsum(np.concatenate([[True], np.diff(h[one]) != 0])) - 1
    several = np.bincount(group)[group] > 1
    one, group = one[several], group[several]
    # Equal windows have equal anchors, so groups of anchors are sorted apart.
    for part in _slices(group, lengths[one]):
        some = one[part]
        size, n = lengths[some] + MIN_BYTES - 1, lengths[some]
        data = np.frombuffer(b"".join(texts_[i] for i in some.tolist()), np.uint8)
        inside = np.repeat(np.arange(len(some)), n)
        inner = np.arange(len(inside)) - np.repeat(np.cumsum(n) - n, n)
        order, lcp = suffix_array(data, (np.cumsum(size) - size)[inside] + inner)
        removed = order[previous_factor(docs[some][inside][order], lcp) >= MIN_BYTES]
        which = some[inside[removed]]
        who.append(which)
        at.append(starts[which] + inner[removed])
        to.append(at[-1])
    who, at, to = (np.concatenate(x) for x in (who, at, to))
    piece, *found = _merged(pieces[who], of[who].astype(np.int64), at, to)
    return told + [{"piece": p} | _spans(*columns) for p, *columns in _by_piece(piece, *found)]


def _spans_of_rows(piece: list[dict]) -> list[dict]:
    """doc, body and removed windows of a piece's rows, a row for each document."""
    (ids,) = [r for r in piece if r["docs"] is not None]
    docs, bodies = _unpack(ids["docs"], np.int64), _unpack(ids["bodies"], np.int64)
    of = np.concatenate([_unpack(r["of"], np.int32) for r in piece])
    first, last = np.concatenate([_unpack(r["spans"], np.int64).reshape(2, -1) for r in piece], axis=1)
    doc, body, *span = _merged(docs[of], bodies[of], first, last)
    return [{"doc": d, "body": b, "spans": blob} for d, b, blob in zip(*_by_document(doc, body, *span))]


def covered(spans: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that the windows cover."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1] + MIN_BYTES)
    new = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    return spans[new, 0], np.append(ends[np.flatnonzero(new)[1:] - 1], ends[-1])


def _finish(output: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for t, blobs in zip(batch.column(0), batch.column(2)):
                data = t.as_py().encode()
                kept, removed, spans = data, 0, 0
                if blobs.is_valid:
                    windows = np.frombuffer(b"".join(blobs.as_py()), np.int64).reshape(-1, 2)
                    a, z = covered(windows, len(data))
                    kept = b"".join(data[x:y] for x, y in zip([0, *z.tolist()], [*a.tolist(), len(data)]))
                    removed, spans = len(data) - len(kept), len(a)
                for c, v in zip(cols, (len(data), removed, spans, hashlib.sha256(kept).hexdigest() if output == "digest" else kept)):
                    c.append(v)
            last = pa.string() if output == "digest" else pa.binary()
            arrays = [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), last))]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", output: str = "full") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept, one row per row: the bytes
    that stay (binary, since a cut may fall inside a character), or with
    ``output="digest"`` their SHA-256.

    doc_id must be an integer (anything else raises). Null texts are empty. A null doc_id comes after
    all others. Rows of the same doc_id, repeated ones too, do not remove from
    each other. A very long text is one piece: a task holds some eight arrays of its
    length while it is hashed. An empty table gives an empty result.
    """
    base = texts(docs, id_col, text_col)
    if not isinstance(base.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer, not {base.schema['doc_id'].dataType.simpleString()}")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NULL_ORDER)))
    base = base.select("text", "doc_id", order.alias("doc"), F.xxhash64("text").alias("body"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, size // BUCKET_BYTES)

    # One plan: the texts are dealt by document once and joined twice.
    rows = base.select("text", "doc_id", "doc", "body")
    of_row = lambda name: [("doc", pa.int64()), ("body", pa.int64()), (name, pa.binary())]
    lists = (
        base.filter(F.octet_length("text") >= MIN_BYTES).select("text", "doc", "body").mapInArrow(_collect(buckets), _ddl(_COLLECTED_TYPES))
        .groupBy("bucket").applyInArrow(_grouped(_repeated, _FOUND_TYPES), _ddl(_FOUND_TYPES))
        .groupBy("piece").applyInArrow(_grouped(_anchors_of_rows, of_row("hashes")), _ddl(of_row("hashes")))
        .groupBy(F.col("doc").alias("d"), F.col("body").alias("b")).agg(F.collect_list("hashes").alias("hashes"))  # of one text
    )
    repeated = rows.join(lists, (rows["doc"] == lists["d"]) & (rows["body"] == lists["b"])).select("text", "doc", "body", "hashes", "doc_id")
    windows = (
        repeated.sortWithinPartitions("doc", "body").mapInArrow(_stretch(buckets), _ddl(_STRETCH_TYPES))
        .groupBy("bucket").applyInArrow(_grouped(_factors, _SPAN_TYPES), _ddl(_SPAN_TYPES))
        .groupBy("piece").applyInArrow(_grouped(_spans_of_rows, of_row("spans")), _ddl(of_row("spans")))
        .groupBy(F.col("doc").alias("d"), F.col("body").alias("b")).agg(F.collect_list("spans").alias("spans"))  # of one text
    )
    joined = rows.join(windows, (rows["doc"] == windows["d"]) & (rows["body"] == windows["b"]), "left").select("text", "doc_id", "spans")
    id_type = base.schema["doc_id"].dataType.simpleString()
    kind = "string" if output == "digest" else "binary"
    return joined.mapInArrow(_finish(output), f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept {kind}")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(load(spark, sf_dir, "documents"), output="digest")
    return out.withColumnRenamed("kept", "kept_sha256")
