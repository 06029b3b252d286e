"""Operator 10, scoring by a Brown class-based bigram model.

P(w | v) = P(class of w | class of v) * P(w | class of w), and the end of a
text is a token in a class of its own.

1. Spark counts every token of the training texts.
2. Bigrams among the ``CORE_WORDS`` most frequent words are counted over the
   whole corpus; exchange clustering moves these words between classes as long
   as the likelihood grows. Its table has at most CORE_WORDS**2 cells,
   whatever the input.
3. The next words up to ``CLASS_WORDS`` join the class that their counted left
   and right neighbours make likeliest (again a table of bounded size).
4. So does every other word of the training texts, in Spark: the classes of
   the first CLASS_WORDS words beside each are gathered by word, and its class
   is stored with its count. Only words that training never saw have none.
5. Class transitions are counted over the whole corpus. The ``LISTED_WORDS``
   most frequent words and their classes are sent to every task, a bounded
   list; a pair with other words finds their classes by joins.
6. Texts are scored: again by the list, and by a join for all other words.

Transitions are smoothed towards the class frequencies. Unseen words are one
word in an open class; every token of a word that training saw once counts once
more as an unseen one in the transitions (Good-Turing).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, staged, texts

CORE_WORDS = 768
CLASS_WORDS = 12_000
LISTED_WORDS = 150_000
CLASSES = 32
SWEEPS = 12
ALPHA = 10.0  # weight of the class frequencies in transitions
DELTA = 0.5
FIXED = 1 << 24  # log-likelihoods as whole numbers
PIECE_BYTES = 1_000_000  # of text scored at a time
END = b""  # no word is empty


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, and then the end."""
    return [*text.encode().lower().split(), END]


def exchange(pairs: np.ndarray, words: int, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the first ``words`` rows of a square bigram table, whose other
    rows are fixed classes of their own. Each word in turn goes to the class that
    raises the class-bigram likelihood most, until a sweep moves none."""
    n = len(pairs)
    fixed = n - words
    total = classes + fixed
    of = np.concatenate([np.arange(words) % classes, classes + np.arange(fixed)])
    pairs = pairs.astype(float)
    member = np.zeros((n, total))
    member[np.arange(n), of] = 1
    right, left = pairs @ member, pairs.T @ member  # of word x class
    table = member.T @ right
    f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    def value(t: np.ndarray) -> np.ndarray:  # of a stack of class tables
        return f(t).sum((-1, -2)) - f(t.sum(-1)).sum(-1) - f(t.sum(-2)).sum(-1)

    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            old, itself = of[w], pairs[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[old] -= itself
            l[old] -= itself
            table[old] -= r
            table[:, old] -= l
            table[old, old] -= itself
            stack = np.repeat(table[None], classes, 0)
            k = np.arange(classes)
            stack[k, k] += r
            stack[k, :, k] += l
            stack[k, k, k] += itself
            gain = value(stack)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9 * abs(gain[old]):
                new = old
            table = stack[new]
            if new != old:
                moved += 1
                of[w] = new
                right[:, old] -= pairs[:, w]
                right[:, new] += pairs[:, w]
                left[:, old] -= pairs[w]
                left[:, new] += pairs[w]
        if not moved:
            break
    return of


@dataclass(frozen=True)
class ClassModel:
    """Log10 probabilities; the open class, of unseen words alone, and the end
    come last."""

    listed: dict  # word -> (class, count), of the listed words and the end
    transition: np.ndarray
    sizes: np.ndarray  # tokens of each class
    train_tokens: int  # N
    train_words: int  # V

    @property
    def open(self) -> int:
        return len(self.sizes) - 2

    def open_emission(self, count: float) -> float:
        return math.log10((count + DELTA) / self.open_mass)

    @property
    def open_mass(self) -> float:
        return float(self.sizes[self.open]) + DELTA

    @property
    def base_mass(self) -> float:
        return self.train_tokens + self.train_words + 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for t in batch.column(0):
            seen.update(tokens(t.as_py()))
        yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def _sequence(batch: pa.RecordBatch, ids: dict, other: int, end: int) -> np.ndarray:
    """The ids of a batch's texts in a row, an end before the first."""
    parts = [end]
    get = ids.get
    for t in batch.column(0):
        parts += [get(w, other) for w in tokens(t.as_py())]
    return np.array(parts, np.int64)


def _tally(keys: np.ndarray) -> pa.RecordBatch:
    values, n = np.unique(keys, return_counts=True)
    return pa.record_batch([pa.array(values, pa.int64()), pa.array(n, pa.int64())], ["k", "n"])


def _pairs(shared, other: int, end: int, size: int):
    """Counts of neighbours, as first * size + second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        for batch in batches:
            s = _sequence(batch, ids, other, end)
            yield _tally(s[:-1] * size + s[1:])

    return run


def _contexts(shared, first: int, classes: np.ndarray, size: int):
    """Counts of the class beside each word from ``first`` on, as
    (word * 2 + side) * size + class."""
    last = len(classes)  # ids first .. last - 1 are the words to assign
    of = np.append(classes, [size - 2, size - 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        for batch in batches:
            s = _sequence(batch, ids, last, last + 1)
            c = of[s]
            at = np.flatnonzero((s >= first) & (s < last))  # never the first or last of s
            word = (s[at] - first) * 2
            yield _tally(np.concatenate([word * size + c[at - 1], (word + 1) * size + c[at + 1]]))

    return run


class _Ids(dict):
    """Ids of known words, and new ones from ``first`` on for others as they come."""

    def __init__(self, known: dict, first: int):
        super().__init__(known)
        self.first, self.new = first, []

    def __missing__(self, word: bytes) -> int:
        self[word] = i = self.first + len(self.new)
        self.new.append(word)
        return i

    def sequence(self, batch: pa.RecordBatch, end: int) -> np.ndarray:
        parts = [end]
        for t in batch.column(0):
            parts.extend(map(self.__getitem__, tokens(t.as_py())))
        return np.array(parts, np.int64)


def _binary(words: list[bytes], at: np.ndarray, use: np.ndarray) -> pa.Array:
    """words[at] where ``use``, else null."""
    return pa.array(words, pa.binary()).take(pa.array(at, mask=~use))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the first column in other batches, so that equal ones come
    in the same."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0)
        start = int(pc.equal(key, key[-1]).to_numpy(zero_copy_only=False).argmax())
        if start or (held and held[0].column(0)[0] != key[0]):
            yield from _joined([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    yield from _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return pa.Table.from_batches(batches).combine_chunks().to_batches() if batches else []


def _beside(shared, open_: int, end: int, states: int):
    """(word, codes) of the words without a class: side * states + state of each
    neighbour, two a token; ``open_`` stands for neighbours without a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _Ids(shared.value, states)
            s = ids.sequence(batch, end)
            c = np.where(s >= states, open_, s)
            at = np.flatnonzero(s >= states)  # never the first or last of s
            word = np.tile(s[at] - states, 2)
            codes = np.concatenate([c[at - 1], states + c[at + 1]]).astype(np.uint16)
            codes = codes[np.argsort(word, kind="stable")]
            ends = np.cumsum(np.bincount(word, minlength=len(ids.new))) * 2
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), len(ids.new), [None, pa.py_buffer(offsets), pa.py_buffer(codes.tobytes())])
            yield pa.record_batch([pa.array(ids.new, pa.binary()), blobs], ["word", "codes"])

    return run


def _assign(weights: np.ndarray, cost: np.ndarray, open_: int, size: int, states: int):
    """Of codes sorted by word: (word, n, class) with the likeliest class by all
    of them, and the transitions that they tell of, as k and n. Weights are whole
    numbers, so that the order of the sums does not matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole(batches):
            word = batch.column(0).dictionary_encode()
            _, offsets, data = batch.column(1).buffers()
            first, last = np.frombuffer(offsets, np.int32)[[batch.column(1).offset, batch.column(1).offset + len(batch)]]
            codes = np.frombuffer(data, np.uint8)[first:last].view(np.uint16).astype(np.int64)
            at = np.repeat(word.indices.to_numpy(), pc.binary_length(batch.column(1)).to_numpy() // 2)
            v = len(word.dictionary)
            seen = np.bincount(at * len(weights) + codes, minlength=v * len(weights)).reshape(v, -1).astype(float)
            n = (seen.sum(1) / 2).astype(np.int64)
            value = seen @ weights - n[:, None] * cost
            of = value.argmax(1)
            own, other = (of + size * (n == 1))[at], codes % states
            keys = np.where(codes < states, other * states + own, own * states + other)[other != open_]
            tally = np.bincount(keys)
            k = np.flatnonzero(tally)
            yield pa.record_batch([
                pa.concat_arrays([word.dictionary, pa.nulls(len(k), pa.binary())]), pa.array(np.concatenate([n, tally[k]]), pa.int64()),
                pa.concat_arrays([pa.array(of, pa.int32()), pa.nulls(len(k), pa.int32())]),
                pa.concat_arrays([pa.nulls(v, pa.int64()), pa.array(k, pa.int64())]),
            ], ["word", "n", "class", "k"])

    return run


def _other_pairs(shared, states: int):
    """Counts of neighbours that both are beyond the first words (whose id is
    0), (k, a, b, n): k is first * states + second if both are listed, and the
    state of the listed one if one is; a and b are the first and the second if
    not listed, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _Ids(shared.value, states + 1)
            s = ids.sequence(batch, 0)
            size = states + len(ids.new)
            at = np.flatnonzero((s[:-1] > 0) & (s[1:] > 0))
            keys, n = np.unique((s[at] - 1) * size + s[at + 1] - 1, return_counts=True)
            a, b = keys // size, keys % size
            in_a, in_b = a < states, b < states
            k = np.where(in_a & in_b, a * states + b, np.where(in_a, a, np.where(in_b, b, -1)))
            yield pa.record_batch([
                pa.array(k, pa.int64()), _binary(ids.new, a - states, ~in_a), _binary(ids.new, b - states, ~in_b), pa.array(n, pa.int64()),
            ], ["k", "a", "b", "n"])

    return run


def _states(train: DataFrame, shared, rest: DataFrame, told: DataFrame, size: int) -> np.ndarray:
    """Transitions to and from the words beyond the first: ``told`` has those
    from and to the first words. ``rest`` has the words that are not listed, and
    more. A state is the class, or ``size`` more for words seen once."""
    states = 2 * size
    pairs = staged(train.mapInArrow(_other_pairs(shared, states), "k long, a binary, b binary, n long"), "op10-pairs")
    state = (F.col("class") + F.when(F.col("n") == 1, size).otherwise(0)).cast("long")
    first, second = (rest.select(F.col("word").alias(x), state.alias(f"s{x}")) for x in "ab")
    a, b = F.col("a").isNotNull(), F.col("b").isNotNull()
    key = (F.col("sa") * states + F.col("sb")).alias("k")
    both = pairs.filter(a & b).join(first, "a").join(second, "b").select(key, "n")
    left = pairs.filter(a & ~b).join(first, "a").withColumn("sb", F.col("k")).select(key, "n")
    right = pairs.filter(~a & b).join(second, "b").withColumn("sa", F.col("k")).select(key, "n")
    listed = pairs.filter(~a & ~b).select("k", "n")
    t = listed.union(left).union(right).union(both).union(told).groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    return _dense((t.column("k").to_numpy(), t.column("n").to_numpy()), states, states)


def _sum(df: DataFrame, function) -> tuple[np.ndarray, np.ndarray]:
    """Totals of a tally whose keys are bounded by the table's size."""
    t = df.mapInArrow(function, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    return t.column("k").to_numpy(), t.column("n").to_numpy()


def _dense(got: tuple[np.ndarray, np.ndarray], *shape: int) -> np.ndarray:
    out = np.zeros(shape)
    out.reshape(-1)[got[0]] = got[1]
    return out


def fit_classes(
    train: DataFrame,
    core_words: int = CORE_WORDS,
    class_words: int = CLASS_WORDS,
    listed_words: int = LISTED_WORDS,
    classes: int = CLASSES,
) -> tuple[ClassModel, DataFrame]:
    """Learn from all rows of a ``text`` column: the model, and (word, n, class)
    of every word beyond the first ``class_words``. Ties of frequency go to the
    smaller word."""
    sc = train.sparkSession.sparkContext
    train = train.select("text")
    counts = staged(
        train.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "op10-counts"
    )
    facts = counts.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("V")).first()
    total, distinct = facts.N or 0, facts.V
    top = counts.filter(F.length("word") > 0).orderBy(F.desc("n"), "word").limit(min(class_words, listed_words)).toArrow()
    words = top.column("word").to_pylist()
    freq = np.array(top.column("n").to_pylist(), np.int64)
    ends = total - int(counts.filter(F.length("word") > 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])

    core, named = min(core_words, len(words)), min(class_words, len(words))
    k = max(1, min(classes, core))
    size = k + 2  # and the open class and the end
    ids = sc.broadcast({w: i for i, w in enumerate(words[:core])} | {END: core + 1})
    pairs = _dense(_sum(train, _pairs(ids, core, core + 1, core + 2)), core + 2, core + 2)
    of = exchange(pairs, core, k)
    member = np.eye(size)[of]
    table = member.T @ pairs @ member

    ids = sc.broadcast({w: i for i, w in enumerate(words[:named])} | {END: named + 1})
    known = np.concatenate([of[:core], np.full(named - core, k)])
    if named > core:
        seen = _dense(_sum(train, _contexts(ids, core, known, size)), named - core, 2, size)
        row, col = table.sum(1), table.sum(0)
        log_next = np.log((table + 0.5) / (row[:, None] + 0.5 * size))  # of the next class, given one
        value = seen[:, 0] @ log_next[:, :k] + seen[:, 1] @ log_next[:k].T - freq[core:named, None] * np.log(col[:k] + 1)
        known[core:] = value.argmax(1)

    # A word seen once is a state apart from the others of its class.
    states = 2 * size
    own = [int(c) + size * int(n == 1) for c, n in zip(known, freq)]
    ids = sc.broadcast(dict(zip(words, own)) | {END: k + 1})
    pairs = _dense(_sum(train, _pairs(ids, k, k + 1, states)), states, states)
    table = pairs.reshape(2, size, 2, size).sum((0, 2))
    row, col = table.sum(1), table.sum(0)
    log_next = np.log((table + 0.5) / (row[:, None] + 0.5 * size))
    fixed = lambda x: np.rint(x * FIXED)
    sides = [log_next[:, :k], log_next[:, :k], log_next[:k].T, log_next[:k].T]
    assign = _assign(fixed(np.concatenate(sides)), fixed(np.log(col[:k] + 1)), k, size, states)
    beside = train.mapInArrow(_beside(ids, k, k + 1, states), "word binary, codes binary")
    beside = beside.repartition("word").sortWithinPartitions("word")
    found = staged(beside.mapInArrow(assign, "word binary, n long, class int, k long"), "op10-classes")
    rest, told = found.filter("word IS NOT NULL").select("word", "n", "class"), found.filter("k IS NOT NULL").select("k", "n")
    more = rest.orderBy(F.desc("n"), "word").limit(max(0, listed_words - named)).toArrow()
    listed = {w: (int(c), int(n)) for w, c, n in zip(words, known, freq)}
    listed |= {w: (c, n) for w, n, c in zip(*(more.column(x).to_pylist() for x in ("word", "n", "class")))}
    listed[END] = (k + 1, ends)

    first = set(words) | {END}
    ids = sc.broadcast({w: 0 if w in first else 1 + c + size * (n == 1) for w, (c, n) in listed.items()})
    pairs[k] = pairs[:, k] = 0
    pairs = (pairs + _states(train, ids, rest, told, size)).reshape(2, size, 2, size)
    table = pairs.sum((0, 2))
    sizes = table.sum(0)
    table[:, k] += pairs[:, :, 1].sum((0, 2))
    table[k] += pairs[1].sum((0, 1))
    table[k, k] += pairs[1, :, 1].sum()
    prior = (table.sum(0) + 1) / (table.sum() + size)
    transition = np.log10((table + ALPHA * prior) / (table.sum(1, keepdims=True) + ALPHA))
    return ClassModel(listed, transition, sizes, int(total), int(distinct)), rest


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about PIECE_BYTES of text, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + PIECE_BYTES, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: ClassModel = shared.value
        index, end = {w: i for i, w in enumerate(m.listed)}, len(m.listed)
        c, n = (np.array(x, np.int64) for x in zip(*m.listed.values()))
        own = np.append(np.log10(np.maximum(n, DELTA) / np.maximum(m.sizes[c], 1.0)), 0.0)
        base = np.append(np.log10((n + 1) / m.base_mass), 0.0)
        known, of = np.append(n > 0, False), np.append(c, -1)  # the last is any word that is not listed
        for batch in _pieces(batches):
            ids, parts, lengths, rows = _Ids(index, end), [], [], batch.num_rows
            for t in batch.column(0):
                words = tokens(t.as_py())
                lengths.append(len(words))
                parts.extend(map(ids.__getitem__, words))
            s = np.array(parts, np.int64)
            lengths = np.array(lengths, np.int64)
            row, i = np.repeat(np.arange(rows), lengths), np.minimum(s, end)
            c = of[i]
            before = np.concatenate([[m.open + 1], c[:-1]])[: len(c)]  # every text ends with the end
            score = own[i] + np.where((c >= 0) & (before >= 0), m.transition[before, c], 0.0)
            rare = np.flatnonzero(c < 0)  # never the last of a text
            items = pa.StructArray.from_arrays([
                pa.array(rare - (np.cumsum(lengths) - lengths)[row[rare]], pa.int32()), _binary(ids.new, s[rare] - end, np.ones(len(rare), bool)),
                pa.array(before[rare], pa.int32()), pa.array(c[rare + 1], pa.int32()),
            ], ["pos", "word", "left", "right"])
            ends = np.cumsum(np.bincount(row[rare], minlength=rows))
            yield pa.record_batch([
                batch.column(1), pa.array(lengths), pa.array(np.bincount(row, known[i], rows).astype(np.int64)),
                pa.array(np.bincount(row, base[i], rows)), pa.array(np.bincount(row, score, rows)),
                pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), items),
            ], ["doc_id", "n_tokens", "known", "base", "score", "rare"])

    return run


def _score_rest(shared):
    """Of each row's words that are not listed, in order: known2, base2 and
    score2, with the transitions to and from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: ClassModel = shared.value
        for batch in _whole(batches):
            rid, n, c, left, right = (batch.column(x).to_numpy() for x in ("rid", "n", "class", "left", "right"))
            start = np.flatnonzero(np.concatenate([[True], rid[1:] != rid[:-1]]))
            score = np.where(c == m.open, m.open_emission(0), np.log10(np.maximum(n, 1) / np.maximum(m.sizes[c], 1.0)))
            score += np.where(left >= 0, m.transition[left, c], 0.0)
            # If the next word is not listed either, it comes next here.
            score += m.transition[c, np.where(right >= 0, right, np.append(c[1:], 0))]
            base = np.log10((n + 1) / m.base_mass)
            sums = [np.add.reduceat(x, start) for x in ((n > 0).astype(np.int64), base, score)]
            yield pa.record_batch([pa.array(x) for x in (rid[start], *sums)], ["rid", "known2", "base2", "score2"])

    return run


def score_texts(docs: DataFrame, model: ClassModel, rest: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10), one row per
    row; ``rest`` is what fit_classes returns beside the model. A null text is
    the empty one, whose only token is the end. Repeated rows are scored each;
    an empty table gives an empty result."""
    base = texts(docs, id_col, text_col).select("text", "doc_id")
    id_type = base.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    item = "struct<pos: int, word: binary, left: int, right: int>"
    schema = f"doc_id {id_type}, n_tokens long, known long, base double, score double, rare array<{item}>"
    # Row ids are drawn in the tasks; being written, they stay what they are.
    work = staged(base.mapInArrow(_score(shared), schema).withColumn("rid", F.monotonically_increasing_id()), "op10-work")
    n, of = F.coalesce("c", F.lit(0).cast("long")).alias("n"), F.coalesce("class", F.lit(model.open)).alias("class")
    rare = (
        work.select("rid", F.explode("rare").alias("r"))
        .join(rest.select(F.col("word").alias("w"), F.col("n").alias("c"), "class"), F.col("r.word") == F.col("w"), "left")
        .select("rid", "r.pos", n, of, "r.left", "r.right")
        .repartition("rid")
        .sortWithinPartitions("rid", "pos")
        .mapInArrow(_score_rest(shared), "rid long, known2 long, base2 double, score2 double")
    )
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return work.drop("rare").join(rare, "rid", "left").select(
        "doc_id", "n_tokens", plus("known", "known2").alias("n_known"),
        plus("base", "base2").alias("base_score"), plus("score", "score2").alias("score"),
    )


def held_out(column: str = "doc_id") -> Column:
    """A null doc_id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(7)) == 2, F.lit(False))


def op10_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(load(spark, sf_dir, "documents"), "doc_id", "text")
    model, rest = fit_classes(docs.filter(~held_out()))
    return score_texts(docs, model, rest).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
