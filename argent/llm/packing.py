"""Operator 12, mixture-controlled packing by deficit round-robin.

Every source is a queue of tokens. A window (a sequence of ``window`` tokens) is
filled by one round: each queue's deficit grows by its share of the window, the
queues are served in turn as far as their deficits go, and what a window could
not serve is carried to the next. Documents are cut where a turn ends, so every
window but the last is full.

1. One scan tokenises the texts and writes the ids, with each row's place in its
   source within the task.
2. Sources that hold less than a token a window share one queue, so there are at
   most ``window`` queues more than the targets name. Rounds run on the driver for
   one cycle of windows only, over a few numbers a queue: a cycle takes the same
   whole number of tokens from each queue again and again (deficits are back at
   zero after it), until the first queue would run dry. Then shares are set
   anew from what is left, which is less by the factor of a cycle; the last
   cycle empties all queues.
3. Prefix sums over (queue, task) give each row its place in its queue, and with
   the cycles every place has its window: deficits carry over from partition
   to partition without a task waiting for another, and no queue is ever
   gathered, however large. Rows are cut where they lie.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from argent.llm.bpe import Codec, _codec, _public
from argent.llm.common import load, staged

WINDOW = 1024
SEPARATOR = 0  # the id that ends a document
CYCLE = 256  # windows, fewer if there are many queues
LEAST = 32  # tokens of a turn, unless the queue or the window ends before
OUT_ROWS, OUT_BYTES = 20_000, 1 << 25


def encode(text: str, codec: Codec) -> bytes:
    """The ids of a whole text as little-endian 32-bit numbers, special tokens
    in it included, as the tokenizers library gives them."""
    return codec.enc.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


def apportion(weights: list[int], total: int, most: list[int]) -> list[int]:
    """``total`` tokens in proportion to ``weights``, none over ``most``, by
    largest remainders (ties to the earlier queue)."""
    out = [0] * len(weights)
    free = [k for k, m in enumerate(most) if m > 0]
    while free:
        total_weight = sum(weights[k] for k in free)
        share = (lambda k: weights[k]) if total_weight else (lambda k: most[k])
        total_weight = total_weight or sum(most[k] for k in free)
        full = [k for k in free if total * share(k) >= most[k] * total_weight]
        if full and len(full) < len(free):
            for k in full:
                out[k], total = most[k], total - most[k]
            free = [k for k in free if k not in set(full)]
            continue
        for k in free:
            out[k] = min(most[k], total * share(k) // total_weight)
        left = total - sum(out[k] for k in free)
        for k in sorted(free, key=lambda k: (-(total * share(k) % total_weight), k)):
            more = min(left, 1, most[k] - out[k])
            out[k], left = out[k] + more, left - more
        return out
    return out


def rounds(amounts: list[int], window: int, least: int) -> list[list[tuple[int, int]]]:
    """The turns (queue, tokens) of every window of a cycle that takes
    ``amounts`` from the queues, by deficit round-robin. Deficits count in
    parts of a token, so that they are whole numbers."""
    total = sum(amounts)
    rest, deficit, out = list(amounts), [0] * len(amounts), []
    while (room := min(window, sum(rest))) > 0:
        turns = [0] * len(amounts)
        for k, amount in enumerate(amounts):
            deficit[k] += amount * window
            turn = min(deficit[k] // total, rest[k], room)
            if turn >= min(least, rest[k]):
                turns[k] += turn
                room -= turn
                rest[k] -= turn
                deficit[k] -= turn * total
        while room:  # what held-back deficits left open goes to the largest
            k = max((k for k, n in enumerate(rest) if n), key=lambda k: (deficit[k], -k))
            turn = min(max(least, deficit[k] // total), rest[k], room)
            turns[k] += turn
            room -= turn
            rest[k] -= turn
            deficit[k] -= turn * total
        out.append([(k, n) for k, n in enumerate(turns) if n])
    return out


@dataclass
class Phase:
    """``cycles`` equal cycles. For each queue: its tokens before the phase, its
    tokens a cycle, and the first token, stream place and size of its turns."""

    base: int
    length: int
    cycles: int
    start: list[int]
    amount: list[int]
    turns: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def phases(tokens: list[int], weights: list[int] | None, window: int = WINDOW, cycle: int = CYCLE, least: int = LEAST) -> list[Phase]:
    """The whole schedule of queues that hold ``tokens``. Without ``weights`` the
    shares are those of the tokens left."""
    rest, start, base, out = list(tokens), [0] * len(tokens), 0, []
    cycle = max(16, min(cycle, 65_536 // max(1, len(tokens))))
    while left := sum(rest):
        amount = list(rest) if left <= cycle * window else apportion(weights or rest, cycle * window, rest)
        cycles = min(r // a for r, a in zip(rest, amount) if a)
        found: list[list[tuple[int, int, int]]] = [[] for _ in tokens]
        place, taken = 0, [0] * len(tokens)
        for turns in rounds(amount, window, least):
            for k, n in turns:
                found[k].append((taken[k], place, n))
                taken[k], place = taken[k] + n, place + n
        turns = [tuple(np.array(f, np.int64).reshape(-1, 3).T) for f in found]
        out.append(Phase(base, place, cycles, list(start), amount, turns))
        base += place * cycles
        for k, a in enumerate(amount):
            rest[k] -= a * cycles
            start[k] += a * cycles
    return out


def cut(plan: list[Phase], queue: int, at: int, n: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the row, size, place in the stream) of the pieces of a row whose
    ``n`` tokens begin ``at`` in its queue."""
    got = []
    first = max(0, bisect_right(plan, at, key=lambda p: p.start[queue]) - 1)
    for p in plan[first:]:
        s, a = p.start[queue], p.amount[queue]
        if s >= at + n:
            break
        lo, hi = max(at, s) - s, min(at + n, s + a * p.cycles) - s
        if not a or lo >= hi:
            continue
        firsts, places, sizes = p.turns[queue]
        e = len(firsts)
        one = lo // a * e + int(np.searchsorted(firsts, lo % a, "right")) - 1
        last = (hi - 1) // a * e + int(np.searchsorted(firsts, (hi - 1) % a, "right"))
        turn = np.arange(one, last)
        c, k = turn // e, turn % e
        begin = c * a + firsts[k]
        low, high = np.maximum(begin, lo), np.minimum(begin + sizes[k], hi)
        stream = p.base + c * p.length + places[k] + (low - begin)
        got.append((low + s - at, high - low, stream))
    start, size, stream = (np.concatenate(x) for x in zip(*got))
    windows = (stream + size - 1) // window - stream // window + 1
    if (windows > 1).any():  # a turn that reaches over a border
        of = np.repeat(np.arange(len(size)), windows)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        low = np.maximum(stream[of], (stream[of] // window + nth) * window)
        high = np.minimum((stream + size)[of], (stream[of] // window + nth + 1) * window)
        start, size, stream = start[of] + low - stream[of], high - low, low
    return start, size, stream


def _tokenise(vocabulary: str):
    end = np.array([SEPARATOR], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, task = _codec(vocabulary), TaskContext.get().partitionId()
        seen: dict = {}  # tokens of each source of this task
        for batch in batches:
            at, held, done = 0, 0, []
            sources = batch.column(2).to_pylist()
            for k, t in enumerate(batch.column(1)):
                ids = encode(t.as_py(), codec) + end
                done.append((seen.get(sources[k], 0), len(ids) // 4, ids))
                seen[sources[k]] = seen.get(sources[k], 0) + len(ids) // 4
                held += len(ids)
                if held >= OUT_BYTES or k + 1 == batch.num_rows:
                    before, n, got = zip(*done)
                    part = batch.slice(at, len(done))
                    yield pa.record_batch(
                        [pa.array([task] * len(done), pa.int32()), part.column(0), part.column(2), pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(got, pa.binary())],
                        ["task", "doc_id", "source", "before", "n", "ids"],
                    )
                    at, held, done = k + 1, 0, []

    return run


def _cut(plan, window: int, output: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            of: list[int] = []

            def out() -> pa.RecordBatch:
                start, size, stream = (np.concatenate(x) for x in zip(*(r[:3] for r in rows)))
                last = [x for r in rows for x in r[3]]
                rest = pa.array(last, pa.int64() if output == "crc" else pa.list_(pa.int32()))
                docs = pa.array(np.repeat(of, [len(r[0]) for r in rows]))
                doc, source, n = (batch.column(k).take(docs) for k in (0, 1, 2))
                return pa.record_batch(
                    [doc, pa.array(start), pa.array(size), rest, n, pa.array(stream // window), pa.array(stream % window), source],
                    ["doc_id", "start", "length", "ids_crc32" if output == "crc" else "ids", "doc_tokens", "sequence_id", "offset", "source"],
                )

            held = 0
            for k, (n, ids, queue, at) in enumerate(zip(*(batch.column(c) for c in (2, 3, 4, 5)))):
                ids = ids.as_buffer()
                start, size, stream = cut(plan.value, queue.as_py(), at.as_py(), n.as_py(), window)
                spans = list(zip((4 * start).tolist(), (4 * (start + size)).tolist()))
                data = memoryview(ids)
                if output == "crc":
                    last = [zlib.crc32(data[a:z]) for a, z in spans]
                else:
                    last = [np.frombuffer(data[a:z], "<u4").astype(np.int32) for a, z in spans]
                rows.append((start, size, stream, last))
                of.append(k)
                held += len(start)
                if held >= OUT_ROWS:
                    yield out()
                    rows, of, held = [], [], 0
            if rows:
                yield out()

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    targets: dict[str, float] | None = None,
    vocabulary: str | None = None,
    window: int = WINDOW,
    cycle: int = CYCLE,
    least: int = LEAST,
    output: str = "ids",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (array<int>; with
    ``output="crc"`` their crc32 as unsigned little-endian 32-bit numbers,
    ``ids_crc32``), doc_tokens, sequence_id, offset, source.

    ``targets`` are the shares of the sources they name in every window; others
    share what is left of 1 by their size. Without targets each source has its
    share of all tokens. A source that runs dry leaves its turn to the rest, and no
    token is left out. A turn is ``least`` tokens or more, so a source of a
    smaller share takes part every few windows only.

    A null or empty text has one token, the separator. A null source is a source
    of its own. Rows that repeat, or have a null doc_id, are packed each for
    itself. A very long text is cut like any other; a task holds its ids while it
    is cut. An empty table gives no pieces. Other columns are not looked at.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or _public("byte_bpe_50k.tiktoken")
    base = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
    )
    id_type = base.schema["doc_id"].dataType.simpleString()
    work = base.mapInArrow(_tokenise(vocabulary), f"task int, doc_id {id_type}, source string, before long, n long, ids binary")
    work = staged(work, "op12-ids")

    held = staged(work.groupBy("task", "source").agg(F.sum("n").alias("n")), "op12-held")
    by_source = held.groupBy("source").agg(F.sum("n").cast("decimal(38,0)").alias("n"))
    total = int(by_source.agg(F.sum("n")).first()[0] or 0)
    named = targets or {}
    large = by_source.filter((F.col("n") * window >= total) | F.coalesce(F.col("source").isin(list(named)), F.lit(False)))
    large = sorted(((r["source"], int(r["n"])) for r in large.collect()), key=lambda r: (r[0] is None, r[0]))  # at most window + targets
    tokens = [n for _, n in large]
    tokens.append(total - sum(tokens))  # of the queue shared by the rest
    weights = None
    if named:
        over = total - sum(n for s, n in large if s in named)
        left = max(0.0, 1 - sum(named.values()))
        share = [named[s] if s in named else left * n / max(1, over) for s, n in [*large, ("", tokens[-1])][:-1]]
        share.append(left * tokens[-1] / max(1, over))
        weights = [round(x * (1 << 40)) for x in share]
    plan = spark.sparkContext.broadcast(phases(tokens, weights, window, cycle, least))

    queues = spark.createDataFrame([(s, k) for k, (s, _) in enumerate(large)], "name string, queue int")
    held = held.join(F.broadcast(queues), F.col("source").eqNullSafe(F.col("name")), "left")
    held = held.select("task", "source", "n", F.coalesce("queue", F.lit(len(large))).alias("queue"))
    tasks = held.groupBy("queue", "task").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = tasks.select("queue", "task", before.alias("earlier"))  # a row per task and queue
    within = Window.partitionBy("queue", "task").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    places = held.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(tasks, ["queue", "task"])
    places = places.select(F.col("task").alias("t"), F.col("source").alias("s"), "queue", (F.col("earlier") + F.col("within")).alias("first"))
    places = staged(places, "op12-places")  # so that its size decides the join

    rows = work.join(places, (F.col("task") == F.col("t")) & F.col("source").eqNullSafe(F.col("s")))
    rows = rows.select("doc_id", "source", "n", "ids", "queue", (F.col("first") + F.col("before")).alias("at"))
    last = "ids_crc32 long" if output == "crc" else "ids array<int>"
    return rows.mapInArrow(
        _cut(plan, window, output),
        f"doc_id {id_type}, start long, length long, {last}, doc_tokens long, sequence_id long, offset long, source string",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from ``pack``'s pieces. A
    sequence has at most as many tokens as the window."""
    part = F.struct("offset", "ids")
    got = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return got.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), output="crc")
