"""Operator 1, benchmark decontamination by spaced-seed hashing (native).

Texts become word sequences (runs of letters and digits in lower case). Fixed
masks of span 8 and 9 hash six chosen words at every place and ignore the
others, on both sides; equal hashes are hits. Around each hit the benchmark item
is laid over the text, and words are compared one by one: a document is
contaminated by an item if some stretch of ``STRETCH`` words in a row agrees in
all but ``SUBSTITUTIONS`` of them.

The two masks together miss no such stretch: wherever two words of thirteen
are substituted, one of them fits between (tests/llm checks all cases). An
item shorter than the stretch must occur whole, and gets a mask of its own
length without gaps; items under ``MIN_WORDS`` words are too short to tell.

The benchmark's seeds are broadcast in blocks of at most ``BLOCK_SEEDS`` rows,
so the size of what is sent is bounded whatever the benchmark; only hits are
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, staged

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
STRETCH, SUBSTITUTIONS = 13, 2
MIN_WORDS = 5
BLOCK_SEEDS = 500_000
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def _seeds(hashes: str, n: str, masks: tuple[tuple[int, ...], ...]) -> Column:
    """One array of hashes per mask: element i is the seed at word i."""

    def of(mask: tuple[int, ...]) -> Column:
        places = F.sequence(F.lit(0), F.col(n) - (mask[-1] + 1))
        seed = F.transform(places, lambda i: F.xxhash64(F.lit(len(mask)), *(F.get(hashes, i + o) for o in mask)))
        return F.when(F.col(n) > mask[-1], seed)

    return F.array(*map(of, masks))


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct word sequences: (item, item_ids, hashes, n)."""
    base = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), words(F.col(f"`{text_col}`").cast("string")).alias("w"))
    base = base.select("item_id", F.transform("w", lambda x: F.xxhash64(x)).alias("hashes")).filter(F.size("hashes") >= MIN_WORDS)
    return base.groupBy("hashes").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")).select(
        F.xxhash64("hashes").alias("item"), "item_ids", "hashes", F.size("hashes").alias("n")
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_seeds: int = BLOCK_SEEDS,
) -> DataFrame:
    """row (a struct of all input columns), doc_id, item_ids (sorted, distinct)
    and contaminated, one row per row.

    Null and empty texts and items match nothing. Rows that repeat doc_id and
    text share their result; so do items of the same words. An empty table on
    either side contaminates nothing.
    """
    row = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).withColumn("body", F.xxhash64("text"))
    items = staged(_items(benchmark, item_col, item_text_col), "op1-items")
    short = [r.n for r in items.filter(F.col("n") < STRETCH).select("n").distinct().orderBy("n").collect()]  # at most 8
    masks = (*MASKS, *(tuple(range(n)) for n in short))

    seeds = items.select("item", F.col("n").alias("m"), F.posexplode(_seeds("hashes", "n", masks)).alias("mask", "s")).filter(
        # A whole short item only by its own mask, all others by the spaced ones.
        F.when(F.col("m") < STRETCH, F.col("mask") >= len(MASKS)).otherwise(F.col("mask") < len(MASKS))
    )
    seeds = seeds.select("item", "mask", F.posexplode("s").alias("j", "seed")).filter("seed IS NOT NULL")
    seeds = staged(seeds.select("seed", "mask", "item", "j"), "op1-seeds")
    blocks = max(1, -(-seeds.count() // (block_seeds // 2)))  # hashing fills blocks unevenly

    hashed = row.select("doc_id", "body", F.transform(words("text"), lambda x: F.xxhash64(x)).alias("hashes"))
    hashed = hashed.select("doc_id", "body", "hashes", F.size("hashes").alias("n"))
    places = (
        hashed.select("doc_id", "body", F.posexplode(_seeds("hashes", "n", masks)).alias("mask", "s"))
        .select("doc_id", "body", "mask", F.posexplode("s").alias("i", "seed"))
    )
    hits = None
    for b in range(blocks):
        block = seeds if blocks == 1 else seeds.filter(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == b)
        found = places.join(F.broadcast(block), ["seed", "mask"]).select("doc_id", "body", "item", (F.col("i") - F.col("j")).alias("shift"))
        hits = found if hits is None else hits.unionByName(found)
    hits = staged(hits.distinct(), "op1-hits")

    laid = (
        hits.withColumnRenamed("doc_id", "i").withColumnRenamed("body", "b")
        .join(items.select("item", "item_ids", F.col("hashes").alias("item_hashes"), F.col("n").alias("m")), "item")
        .groupBy("i", "b").agg(F.collect_list(F.struct("item_ids", "item_hashes", "m", "shift")).alias("laid"))  # one text's hits
    )
    hit_rows = row.join(laid, F.col("doc_id").eqNullSafe(F.col("i")) & F.col("body").eqNullSafe(F.col("b")), "left")
    # Words are taken again only from texts that have hits.
    again = F.when(F.col("laid").isNotNull(), F.transform(words("text"), lambda x: F.xxhash64(x)))
    hit_rows = hit_rows.select("row", "doc_id", "laid", again.alias("hashes"))
    return _verified(hit_rows)


def _verified(hit_rows: DataFrame) -> DataFrame:
    def agreement(x: Column) -> Column:
        need = F.least(x["m"], F.lit(STRETCH))
        low = F.greatest(F.lit(0), -x["shift"])
        high = F.least(x["m"], F.size("hashes") - x["shift"]) - need  # last start of a stretch
        agrees = lambda t: (F.get(x["item_hashes"], t) == F.get("hashes", t + x["shift"])).cast("int")
        most = F.array_max(F.transform(F.sequence(low, high), lambda s: F.aggregate(
            F.sequence(s, s + need - 1), F.lit(0), lambda a, t: a + agrees(t)
        )))
        allowed = F.when(x["m"] < STRETCH, 0).otherwise(SUBSTITUTIONS)
        return F.when(high >= low, most >= need - allowed).otherwise(F.lit(False))

    sound = F.filter("laid", agreement)
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform(sound, lambda x: x["item_ids"]))))
    out = hit_rows.withColumn("item_ids", ids)
    empty = F.array().cast(out.schema["item_ids"].dataType)
    out = out.withColumn("item_ids", F.coalesce("item_ids", empty))
    return out.select("row", "doc_id", "item_ids", (F.size("item_ids") > 0).alias("contaminated"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "contaminated", F.size("item_ids").cast("long").alias("n_items"), F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids")
    )


# Runs of four equal words find the candidates here: eleven of thirteen words
# in three runs make one run of four, and short items are compared whole.
ORACLE_OP1 = rf"""
WITH dw AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{NOT_WORD}'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
bw AS MATERIALIZED (SELECT item_id, w, len(w) AS m, least(len(w), {STRETCH}) AS need, CASE WHEN len(w) < {STRETCH} THEN 0 ELSE {SUBSTITUTIONS} END AS allowed
 FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '{NOT_WORD}'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) >= {MIN_WORDS}),
dg AS (SELECT doc_id, w, i FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM dw WHERE len(w) >= 4)),
bg AS (SELECT item_id, w, j FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS j FROM bw)),
c AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, i - j AS shift FROM dg JOIN bg ON dg.w[i] = bg.w[j] AND dg.w[i + 1] = bg.w[j + 1] AND dg.w[i + 2] = bg.w[j + 2] AND dg.w[i + 3] = bg.w[j + 3]),
e AS (SELECT doc_id, item_id, need, allowed, m, shift, dlen, t, CASE WHEN d = b THEN 1 ELSE 0 END AS eq FROM
 (SELECT c.doc_id, c.item_id, need, allowed, m, shift, len(dw.w) AS dlen, t, dw.w[t + shift] AS d, bw.w[t] AS b
  FROM c JOIN dw USING (doc_id) JOIN bw USING (item_id), unnest(range(1, m + 1)) AS r(t) WHERE t + shift BETWEEN 1 AND len(dw.w))),
f AS (SELECT doc_id, item_id, need, allowed, t, sum(eq) OVER x AS agree, count(*) OVER x AS n FROM e
 WINDOW x AS (PARTITION BY doc_id, item_id, shift ORDER BY t ROWS BETWEEN need - 1 PRECEDING AND CURRENT ROW)),
h AS (SELECT DISTINCT doc_id, item_id FROM f WHERE n = need AND agree >= need - allowed),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids FROM h GROUP BY doc_id)
SELECT d.doc_id AS doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(item_ids, '') AS item_ids
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""
