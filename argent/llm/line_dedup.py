"""Operator 5, line dedup by winnowing over line hashes (native).

The units are a text's non-blank lines, trimmed. Every window of ``window``
consecutive units selects its smallest line hash (the rightmost of equal ones)
as fingerprint, so that two equal windows always select the same place: a run
of ``window`` or more equal lines is guaranteed to share a fingerprint. A unit of
more than ``long_words`` words (between white space) is a run by itself: a
window of one line, whose place is selected as well.

1. Only selected places are written, one row each: the fingerprint and the
   windows that selected it, each as a hash of its whole content.
2. Fingerprints are counted; places whose fingerprint occurs nowhere else are
   left behind.
3. The others are joined by fingerprint and extended to both sides: a place's
   windows reach up to ``window`` - 1 lines to its left and its right, and one that
   the first place with the same lines around it has as well is a match. A
   longer run is the union of its windows, which follow one another.
4. Every line of a window that occurs earlier (in a document of smaller doc_id,
   or further up in the same one) is deleted; the first run stays.

Each content is compared with its first place alone, so a line that occurs a
million times costs a million rows and not their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, release, staged

WINDOW = 2
LONG_WORDS = 50  # a line of more words is a run by itself
TRIM = " \t\r"
PACKED = 18  # bytes of a window


def _windows(n: str, window: int) -> Column:
    """Starts of the windows over n units, none if they are fewer."""
    return F.when(F.col(n) >= window, F.sequence(F.lit(0), F.col(n) - window)).otherwise(F.array().cast("array<int>"))


def _long(unit: Column, long_words: int) -> Column:
    """Whether a unit has more than ``long_words`` words."""
    return F.size(F.split(F.regexp_replace(unit, r"^\s+|\s+$", ""), r"\s+")) > long_words


def _selected(start: Column, window: int) -> Column:
    """The place that a window selects: its smallest line hash, the rightmost
    of equal ones."""
    inside = F.transform(F.sequence(start, start + window - 1), lambda k: F.struct(F.get("hashes", k).alias("h"), (-k).alias("k")))
    return -F.array_min(inside)["k"]


def _byte(n: Column | int) -> Column:
    return F.lpad(F.hex(n if isinstance(n, Column) else F.lit(n)), 2, "0")


def _places(units: DataFrame, window: int, long_words: int | None) -> DataFrame:
    """doc_id, body, fingerprint, at (the unit's number) and windows, a row for
    every selected place. The windows are packed: how far before the place each
    begins, its width (a byte each) and the 16 bytes of its content's hash."""
    starts = _windows("n", window)
    content = lambda k, width: F.md5(F.array_join(F.slice(F.col("units"), k + 1, width), "\n"))
    units = units.withColumns({
        "selected": F.transform(starts, lambda s: _selected(s, window)),
        "contents": F.transform(starts, lambda s: content(s, window)),
    })

    def place(k: Column) -> Column:
        # Of the windows over a place, those that selected it.
        near = F.filter(F.sequence(F.greatest(k - window + 1, F.lit(0)), k), lambda s: F.get("selected", s) == k)
        own = F.array_join(F.transform(near, lambda s: F.concat(_byte(k - s), _byte(window), F.get("contents", s))), "")
        if long_words is not None and window > 1:
            alone = F.concat(_byte(0), _byte(1), content(k, 1))
            own = F.when(_long(F.get("units", k), long_words), F.concat(own, alone)).otherwise(own)
        return F.struct(F.get("hashes", k).alias("fingerprint"), k.alias("at"), F.unhex(own).alias("windows"))

    places = F.filter(F.transform(_windows("n", 1), place), lambda p: F.length(p["windows"]) > 0)
    return units.select("doc_id", "body", F.explode(places).alias("p")).select("doc_id", "body", "p.*")


def _unpacked() -> Column:
    """The windows of a place as (start, width, content)."""
    number = lambda at: F.conv(F.hex(F.substr("windows", at, F.lit(1))), 16, 10).cast("int")
    return F.transform(F.sequence(F.lit(1), F.length("windows"), F.lit(PACKED)), lambda i: F.struct(
        (F.col("at") - number(i)).alias("start"), number(i + 1).alias("width"), F.substr("windows", i + 2, F.lit(16)).alias("content"),
    ))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, long_words: int | None = LONG_WORDS) -> DataFrame:
    """row (a struct of all input columns, so that none can clash), doc_id,
    text, n_lines (units), n_removed and removed (line numbers from 0), one row
    per row.

    Blank lines are no units: they are never deleted and never part a run. A
    null text stays null, with no lines. A null doc_id comes before all
    others. Rows that repeat doc_id and text are one document, and each gets
    its result; rows that share a doc_id come in order of a hash of the text. A
    text without deleted lines is unchanged. A very long text is treated whole,
    in time in proportion to its lines. An empty table gives an empty result.
    """
    if not 1 <= window <= 255:
        raise ValueError(f"window must be 1 to 255, not {window}")
    row = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).withColumn("body", F.xxhash64("text"))

    units = row.select("doc_id", "body", F.split("text", "\n", -1).alias("lines"))
    units = units.select(
        "doc_id", "body", F.filter(F.transform("lines", lambda x: F.btrim(x, F.lit(TRIM))), lambda x: x != "").alias("units")
    )
    units = units.select(
        "doc_id", "body", "units", F.transform("units", lambda x: F.xxhash64(x)).alias("hashes"), F.size("units").alias("n")
    )

    found = staged(_places(units, window, long_words), "op5-places")
    repeated = staged(
        found.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fingerprint"), "op5-fingerprints"
    )
    # Both lists below grow with the input: sorted joins at every size.
    matched = found.join(repeated.hint("merge"), "fingerprint", "left_semi")
    matched = matched.select("doc_id", "body", "fingerprint", F.explode(_unpacked()).alias("w")).select("doc_id", "body", "fingerprint", "w.*")
    # Written out, so that a hot fingerprint can be split here and combines before
    # the next shuffle.
    matched = staged(matched, "op5-matched")
    release(found, repeated)
    place = F.struct("doc_id", "body", "start")
    first = matched.groupBy("fingerprint", "content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # Written out so that the join's hot fingerprints can be split.
    first = staged(first.filter("n > 1").select("fingerprint", "content", "first"), "op5-first")
    later = matched.join(first.hint("merge"), ["fingerprint", "content"]).filter(place > F.col("first"))
    deleted = later.groupBy(F.col("doc_id").alias("i"), F.col("body").alias("b")).agg(F.collect_set(F.struct("start", "width")).alias("starts"))

    joined = row.join(deleted, F.col("doc_id").eqNullSafe(F.col("i")) & F.col("body").eqNullSafe(F.col("b")), "left")
    joined = joined.select("row", "doc_id", "text", "starts", F.split("text", "\n", -1).alias("lines"))
    numbers = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda k: F.btrim(F.get("lines", k), F.lit(TRIM)) != "")
    joined = joined.withColumn("numbers", F.when(F.col("text").isNotNull(), numbers).otherwise(F.array().cast("array<int>")))
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s["start"], s["start"] + s["width"] - 1))))
    joined = joined.withColumn("gone", gone)
    removed = F.array_sort(F.transform("gone", lambda k: F.get("numbers", k)))
    joined = joined.withColumn("removed", F.coalesce(removed, F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    joined = joined.withColumn("kept", F.when(F.size("removed") > 0, kept))
    text = F.when(F.col("kept").isNotNull(), F.array_join(F.transform("kept", lambda k: F.get("lines", k)), "\n")).otherwise(F.col("text"))
    return joined.select(
        "row", "doc_id", text.alias("text"), F.size("numbers").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"), "removed",
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_OP5 = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, k, line, trim(line, E' \t\r') AS unit FROM l),
u AS (SELECT doc_id, k, unit, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS p FROM t WHERE unit <> ''),
w AS (SELECT a.doc_id, a.p, row_number() OVER (PARTITION BY a.unit, b.unit ORDER BY a.doc_id, a.p) AS nth
 FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.p = a.p + 1),
long AS (SELECT doc_id, p, row_number() OVER (PARTITION BY unit ORDER BY doc_id, p) AS nth FROM u
 WHERE len(string_split_regex(trim(unit, E' \t\r\f\v'), '[ \t\r\f\v]+')) > 50),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, p FROM w WHERE nth > 1 UNION ALL SELECT doc_id, p + 1 FROM w WHERE nth > 1
 UNION ALL SELECT doc_id, p FROM long WHERE nth > 1)),
k AS (SELECT t.doc_id, t.k, t.line, u.p, g.p IS NOT NULL AS deleted FROM t LEFT JOIN u ON t.doc_id = u.doc_id AND t.k = u.k
 LEFT JOIN gone g ON u.doc_id = g.doc_id AND u.p = g.p),
s AS (SELECT doc_id, count(p) AS n_lines, count(*) FILTER (deleted) AS n_removed, string_agg(line, chr(10) ORDER BY k) FILTER (NOT deleted) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id AS doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id
"""
