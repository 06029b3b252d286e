"""Operator 6, n-gram Jaccard join over count vectors.

A text's set holds its distinct word shingles. Hashing them into groups turns a
set into a point, its counts by group, and the sum of the smaller coordinates of
two points bounds the sets' overlap from above.

The points have two resolutions. *Fine* groups form the upper level of the
index. Sets of similar size go by the same tag (two overlapping tags for each
size class), and under a tag the fine groups are dealt into more blocks than two
linked sets can have differing shingles. The counts of linked sets then agree
in a whole block, so equality of one block's counts finds every link; these
blocks are the index cells. Each cell that holds several sets is searched
with an R-tree over *coarse* groups: rectangles, then points, whose summed
minima are too small for the threshold are passed over, and of the points left
those whose minima over four times as many groups are. Surviving pairs are verified
on the whole sets.

Links only matter up to components. A first round verifies one link per set, to
the smallest set of one of its cells, if their points allow it. Later rounds look only at pairs of sets
in different components, each component's best survivor of a cell; the last
round takes all survivors that are left, so no link between components is lost.
Equal sets are one set throughout, and cells larger than ``CHUNK`` sets are dealt
into pairs of chunks, so no task holds a whole hot cell. Cells with the same
members are searched once.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import bitmap, load, release, staged, texts
from argent.llm.components import components

SHINGLE, THRESHOLD = 3, (9, 10)  # the query's contract: 100 * both >= 90 * either
GROUPS, COARSE = 256, 64
LEAF = 16  # points in a rectangle of the R-tree
CHUNK = 2000
BEST_ROUNDS = 2
WANTED_BITS = 23
SALTS = 8  # tasks for the cells with one smallest set
TOLD_PAIRS = 250_000  # remembered by a task
BROADCAST_PAIRS = 100_000
MEMORY_WORDS = 250_000
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[3]
    x = (x ^ (x >> np.uint64(29))) * _K[1]
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    """word -> hash, with a memory of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str, memory: dict, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; with fewer words,
    the whole sequence is one; without words there are none."""
    words = text.encode().lower().split()  # ASCII case and white space
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mix(out * _K[0] + h[k : len(h) - width + 1 + k])
    return np.unique(out)


class Plan:
    """Size classes and numbers of blocks for a threshold of num / den."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(self.starts[-1] * den // num + 1)

    def size_class(self, n: int) -> int:
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    @functools.cache
    def blocks(self, tag: int) -> tuple[int, int]:
        """Linked sets of classes tag, and tag and tag + 1, differ in at most
        ``most`` = (1 - t) / (1 + t) of their summed sizes, so of ``m`` blocks
        at least m - most agree. There are some more blocks than needed, so
        that a set rarely has m - most or more empty ones."""
        size = self.starts[tag + 1] - 1 + self.starts[tag + 2] - 1
        most = size * (self.den - self.num) // (self.den + self.num)
        for m in range(most + 1, 2 * most + 4):
            empty = m * math.exp(-self.starts[tag] / m)
            if m - empty - 4 * math.sqrt(empty) > most:
                return m, most
        return most + 1, most

    def enough(self, both, a, b):
        """Is this overlap of sets of sizes a and b a link?"""
        return both * (self.num + self.den) >= (a + b) * self.num

    def cells(self, h: np.ndarray) -> np.ndarray:
        """Keys of the index cells that a set lies in: tag, block, counts."""
        own = self.size_class(len(h))
        fine = _mix((h & np.uint64(0xFFFFF)) + _K[2])  # a random number for each fine group
        out = []
        for tag in (own - 1, own) if own else (own,):
            m, most = self.blocks(tag)
            block = ((h >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
            # A linear hash of the block's counts, summed exactly in two halves.
            low = np.bincount(block, (fine & np.uint64(0xFFFFFFFF)).astype(np.float64), m)
            high = np.bincount(block, (fine >> np.uint64(32)).astype(np.float64), m)
            key = low.astype(np.uint64) * _K[0] + high.astype(np.uint64) * _K[1]
            key = _mix(_mix(key + _mix(np.array([tag + 1], np.uint64))) + np.arange(m, dtype=np.uint64) * _K[3])
            full = np.bincount(block, minlength=m) > 0
            # Empty blocks agree without meaning. Some full one agrees as well
            # if either set has fewer empty ones than m - most; else both keep all.
            out.append(key[full] if m - most > m - int(full.sum()) else key)
        return np.concatenate(out)


def counts(h: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The point of a set, in 16 bits a group, or 32 if one holds more."""
    n = np.bincount((h >> np.uint64(44)).astype(np.int64) % groups, minlength=groups)
    return n.astype(np.uint16 if n.max() < 1 << 16 else np.uint32)


def points(blobs: list[bytes]) -> np.ndarray:
    """Stored points, one a row."""
    if all(len(x) == 2 * GROUPS for x in blobs):
        return np.frombuffer(b"".join(blobs), np.uint16).reshape(-1, GROUPS).astype(np.int32)
    return np.stack([np.frombuffer(x, np.uint16 if len(x) == 2 * GROUPS else np.uint32).astype(np.int64) for x in blobs])


def _set_id(h: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(h.tobytes()) >> 1  # a positive long


def _cells(plan: Plan, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memory, ids, sizes, keys, done = _WordHashes(), [], [], [], {}
            for t in batch.column(1):
                h = shingles(t.as_py(), memory, size)
                i = _set_id(h) if len(h) else None
                ids.append(i)
                sizes.append(len(h))
                keys.append(None if i is None or i in done else plan.cells(h).view(np.int64))
                done[i] = True
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "body", "sid", "n", "cells"],
            )

    return run


def _shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by cell and set, the members of cells that hold several
    sets, once each, with the cell's smallest set. Only a cell's first set is
    held back, so a cell may be of any size."""
    cell = center = last = None
    told = False
    for batch in batches:
        c, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(c):
            continue
        new = np.concatenate([[c[0] != cell], c[1:] != c[:-1]])
        fresh = new | np.concatenate([[s[0] != last], s[1:] != s[:-1]])  # not a copy of the row before
        start = np.maximum.accumulate(np.where(new, np.arange(len(c)), -1))
        first = np.where(start >= 0, s[np.maximum(start, 0)], center if center is not None else 0)
        more = fresh & ~new  # second and later sets of a cell
        # The first set of a cell is told with the second one.
        lead = np.flatnonzero(more)
        lead = lead[np.concatenate([[True], start[lead][1:] != start[lead][:-1]])] if len(lead) else lead
        if len(lead) and start[lead[0]] < 0 and told:
            lead = lead[1:]
        out_c = np.concatenate([c[lead], c[more]])
        out_s = np.concatenate([first[lead], s[more]])
        out_m = np.concatenate([first[lead], first[more]])
        if len(out_c):
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (out_c, out_s, out_m)], ["cell", "sid", "center"])
        open_here = start[-1] if start[-1] >= 0 else 0
        told = bool(more[open_here:].any()) or (start[-1] < 0 and told)
        cell, center, last = c[-1], first[-1], s[-1]


def _sets(words, bits: int, size: int):
    """The sets of the rows whose keys are in the bitmap, once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, slots = words.value, 1 << bits
        for batch in batches:
            memory, rows, done = _WordHashes(), [], set()
            slot = batch.column(1).to_numpy() % slots
            wanted = table[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1) == 1
            for k in np.flatnonzero(wanted).tolist():
                h = shingles(batch.column(0)[k].as_py(), memory, size)
                i = _set_id(h)
                if len(h) and i not in done:
                    done.add(i)
                    rows.append((i, len(h), counts(h).tobytes(), h.tobytes()))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["sid", "n", "point", "items"])

    return run


def _verify(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(bool(plan.enough(both, len(a), len(b))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good, pa.bool_())], ["a", "b", "linked"])

    return run


def survivors(plan: Plan, n: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """R-tree search in one cell: for each left point the right ones whose summed
    minima reach the threshold, and these sums. Leaves pack points of similar
    size and counts; a rectangle is passed over when even its largest
    coordinates are too small for its smallest set."""
    coarse = at.reshape(len(at), COARSE, -1).sum(2)
    order = right[np.lexsort((*coarse[right][:, :4].T, n[right]))]
    edges = np.arange(0, len(order), LEAF)
    top = np.maximum.reduceat(coarse[order], edges)
    smallest = np.minimum.reduceat(n[order], edges)
    for i in left:
        open_leaves = plan.enough(np.minimum(top, coarse[i]).sum(1), n[i], smallest)
        if not open_leaves.any():
            continue
        inside = order[np.repeat(open_leaves, LEAF)[: len(order)]]
        inside = inside[plan.enough(np.minimum(coarse[inside], coarse[i]).sum(1), n[i], n[inside])]
        bound = np.minimum(at[inside], at[i]).sum(1)
        ok = plan.enough(bound, n[i], n[inside])
        yield i, inside[ok], bound[ok]


def _pairs_of_cell(plan: Plan, best: bool, sid, comp, n, side, at, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one chunk pair of a cell that survive the bounds and lie in
    different components; with ``best`` only the best of each component."""
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    a, b, score = [], [], []
    if len(left) and len(right):
        for i, found, bound in survivors(plan, n, at, left, right):
            keep = (comp[found] != comp[i]) & ((sid[found] > sid[i]) if same else True)
            a += [i] * int(keep.sum())
            b += found[keep].tolist()
            score += bound[keep].tolist()
    if best and a:
        seen, kept = set(), []
        for k in np.lexsort((sid[b], sid[a], -np.array(score))):
            if comp[a[k]] not in seen or comp[b[k]] not in seen:
                seen |= {comp[a[k]], comp[b[k]]}
                kept.append(k)
        a, b = [a[k] for k in kept], [b[k] for k in kept]
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.minimum(sid[a], sid[b]), np.maximum(sid[a], sid[b])


def _search(plan: Plan, best: bool):
    """R-tree search of the chunk pairs of cells, whose rows come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        told: set[tuple[int, int]] = set()
        for batch in _with_end(batches):
            if batch is not None:
                held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held) if held else None
            if table is None or not table.num_rows:
                continue
            keys = [table.column(c).to_numpy() for c in ("cell", "i", "j")]
            change = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
            edges = [0, *change.tolist(), table.num_rows]
            if batch is not None:  # the last cell may go on
                edges.pop()
            held = [table.slice(edges[-1])]
            if len(edges) < 2:
                continue
            sid, comp, n, side = (table.column(c).to_numpy() for c in ("sid", "comp", "n", "side"))
            at = points(table.column("point").slice(0, edges[-1]).to_pylist())
            out = [
                _pairs_of_cell(plan, best, sid[a:z], comp[a:z], n[a:z], side[a:z], at[a:z], keys[1][a] == keys[2][a])
                for a, z in zip(edges, edges[1:])
            ]
            # Near copies meet in many cells, which mostly come to one task: once is enough.
            found = set(zip(*(np.concatenate([o[k] for o in out]).tolist() for k in (0, 1)))) - told
            told = found | (told if len(told) < TOLD_PAIRS else set())
            x, y = zip(*found) if found else ((), ())
            yield pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return run


def _possible(plan: Plan):
    """Of pairs with the sizes and points of both sets, those that may be links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (points(batch.column(c).to_pylist()) for c in ("x", "y"))
                n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
                ok = plan.enough(np.minimum(x, y).sum(1), n, m)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _linked(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """(a, b, linked) of distinct pairs, verified on the whole sets. Only the
    sets of the pairs are shuffled: a list of pairs of up to BROADCAST_PAIRS rows
    goes to the sets, a longer one is joined like any other table."""
    pairs = staged(pairs, "op6-pairs")
    sent = F.broadcast(pairs) if pairs.count() <= BROADCAST_PAIRS else pairs
    with_a = sets.select(F.col("sid").alias("a"), F.col("items").alias("x")).join(sent, "a")
    with_b = sets.select(F.col("sid").alias("b"), F.col("items").alias("y")).join(sent, "b")
    both = with_a.join(with_b, ["a", "b"]).select("a", "b", "x", "y")
    out = staged(both.mapInArrow(_verify(plan), "a long, b long, linked boolean").distinct(), "op6-links")
    release(pairs)
    return out


def _bounded(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """The pairs whose points may be those of linked sets."""
    with_a = pairs.join(sets.select(F.col("sid").alias("a"), "n", F.col("point").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("sid").alias("b"), F.col("n").alias("m"), F.col("point").alias("y")), "b")
    return with_b.select("a", "b", "n", "m", "x", "y").mapInArrow(_possible(plan), "a long, b long")


def _still_open(members: DataFrame, sets: DataFrame, comps: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Cell members with their components, of cells that hold several, and the
    staged tables that they are read from."""
    comps = comps.select(F.col("node").alias("sid"), "component")
    now = members.join(comps, "sid", "left").select("cell", "sid", F.coalesce("component", "sid").alias("comp"))
    now = staged(now, "op6-open-members")
    cells = now.groupBy("cell").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("size"), F.min("sid").alias("least")).filter("x <> y")
    cells = staged(cells.select("cell", "least", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")), "op6-open")
    return now.join(cells, "cell").join(sets.select("sid", "n", "point"), "sid"), [now, cells]


def _chunk_pairs(rows: DataFrame) -> DataFrame:
    """Each member once for every pair of chunks that its own is in."""
    own = F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select(
        "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "sid", "comp", "n", "point",
        "least", F.pmod(F.xxhash64("cell"), F.lit(SALTS)).alias("salt"),
    )


def _together(rows: DataFrame) -> DataFrame:
    """The rows of a chunk pair one after the other. Cells with the same smallest
    set, which mostly hold the same families, come to the same few tasks."""
    return (
        _chunk_pairs(rows).repartition("least", "salt", "i", "j")
        .sortWithinPartitions("least", "cell", "i", "j", "side", "sid").drop("least", "salt")
    )


def _different_cells(members: DataFrame) -> DataFrame:
    """Members of one cell of each distinct membership: near copies share most
    of their cells, and one cell tells as much as its equals. Two independent
    64-bit hashes, the count, the least and the largest set stand for it."""
    by = members.groupBy("cell").agg(
        F.count(F.lit(1)).alias("size"), F.min("sid").alias("low"), F.max("sid").alias("high"),
        F.bit_xor(F.xxhash64("sid")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "sid")).alias("h2"),
    )
    one = staged(by.groupBy("size", "low", "high", "h1", "h2").agg(F.min("cell").alias("cell")).select("cell"), "op6-distinct")
    out = staged(members.join(one, "cell", "left_semi"), "op6-cell-members")
    release(one, members)
    return out


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links
    of Jaccard similarity of at least ``threshold``, itself included), group_id
    (the component itself, null for texts without words) and body (xxhash64 of
    the text), one row per row.

    Texts without words, null ones among them, are linked with nothing.
    Repeated rows are each answered. A null doc_id never becomes a component
    while another is there. An empty table gives an empty result.
    """
    plan = Plan(*threshold)
    spark = docs.sparkSession
    base = texts(docs, id_col, text_col).withColumn("body", F.xxhash64("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    cells = staged(base.mapInArrow(_cells(plan, shingle), f"doc_id {id_type}, body long, sid long, n long, cells array<long>"), "op6-cells")
    in_order = cells.select(F.explode("cells").alias("cell"), "sid").repartition("cell").sortWithinPartitions("cell", "sid")
    shared = staged(in_order.mapInArrow(_shared_cells, "cell long, sid long, center long"), "op6-shared")
    rows = staged(cells.select("doc_id", "body", "sid", "n"), "op6-rows")
    release(cells)  # its keys are most of what is staged
    members = _different_cells(shared)
    # One row of each set that shares a cell is read again for the whole set.
    key = F.xxhash64("doc_id", "body")
    wanted = (
        rows.filter("sid IS NOT NULL").groupBy("sid").agg(F.min(key).alias("key"))
        .join(members.select("sid").distinct(), "sid", "left_semi")
    )
    table = spark.sparkContext.broadcast(np.array(bitmap(wanted, "key", WANTED_BITS), np.int64).view(np.uint64))
    sets = base.select("text", key.alias("key")).mapInArrow(_sets(table, WANTED_BITS, shingle), "sid long, n long, point binary, items binary")
    sets = staged(sets, "op6-sets")

    first = members.filter("sid <> center").groupBy("sid").agg(F.min("center").alias("a")).select("a", F.col("sid").alias("b"))
    tried = _linked(_bounded(first, sets, plan), sets, plan)
    done = [tried]
    comps = components(tried.filter("linked").select("a", "b"))
    stuck = False
    for best in (*(True,) * BEST_ROUNDS, False):
        if best and stuck:  # the best pairs were tried before: on to all of them
            continue
        still, sources = _still_open(members.select("cell", "sid"), sets, comps)
        pairs = staged(_together(still).mapInArrow(_search(plan, best), "a long, b long").distinct(), "op6-survivors")
        release(*sources)
        if pairs.isEmpty():
            release(pairs)
            break
        new = _linked(pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti"), sets, plan)
        release(pairs)
        stuck = new.isEmpty()
        done.append(new)
        tried = tried.unionByName(new)
        if not new.filter("linked").isEmpty():
            old, comps = comps, components(tried.filter("linked").select("a", "b"))
            release(old)
    release(members, sets)

    of_set = rows.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("least"))
    named = of_set.join(comps.select(F.col("node").alias("sid"), "component"), "sid", "left")
    named = staged(named.select("sid", "least", F.coalesce("component", "sid").alias("component")), "op6-named")
    smallest = staged(named.groupBy("component").agg(F.min("least").alias("smallest")), "op6-smallest")
    answer = staged(named.join(smallest, "component").select("sid", "component", "smallest"), "op6-answer")
    release(named, smallest, comps, *done)
    return rows.select("doc_id", "body", "sid", "n").join(answer, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"),
        F.col("component").alias("group_id"), "body",
    )


def one_of_each(docs: DataFrame, shingle: int, threshold: tuple[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows, all columns, with one document of each component: that
    of smallest doc_id (a null one last), then of smallest text hash. Texts
    without words all stay; rows that repeat doc_id and text stay once."""
    found = jaccard_components(docs, id_col, text_col, shingle, threshold)
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "body")
    keepers = (
        found.filter("group_id IS NOT NULL").groupBy("group_id").agg(F.min(key).alias("k")).select("k.doc_id", "k.body")
        .unionByName(found.filter("group_id IS NULL").select("doc_id", "body")).distinct()
    )
    keepers = staged(keepers, "op6-keepers").select(F.col("doc_id").alias("i"), F.col("body").alias("b"))
    row = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("body"),
    )
    kept = row.join(keepers, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("body") == F.col("b")), "left_semi")
    return kept.dropDuplicates(["doc_id", "body"]).select("row.*")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
