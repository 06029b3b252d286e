"""Operator 4, URL filtering by trust and distrust over the host graph.

Rules judge the pages they fit. All other pages get the verdict of their host:
personalised PageRank spreads trust along host edges from hosts with allowed
pages, and distrust along reversed edges from hosts with blocked pages, each
seed weighing as many pages as were so judged. A host is blocked if its
distrust exceeds ``threshold`` times its trust.

Edges are absolute links in the pages' HTML to other hosts, and links both ways
between a host and the domain directly above it (a site is expected to answer
for its subdomains). Everything runs as Spark joins and aggregations; scores are
written to the shared folder every ``STEP`` rounds to cut the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, staged

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = "(?i)(?:href|src)\\s*=\\s*[\"']?(?:https?:)?//([^/?#\"'\\s<>]+)"
DAMPING, ROUNDS, STEP, THRESHOLD = 0.85, 12, 4, 1.0


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, as host and path, and its verdict; else null."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last fit wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _above(host: str) -> Column:
    """The domain above a host, null at the last two labels."""
    rest = F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1)
    return F.when(rest != "", rest)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w) from (host, html): links to other hosts and to the domain
    above, weighted by the number of links or pages."""
    found = pages.filter("host <> ''")
    links = (
        found.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
        .select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    )
    up = found.groupBy("host").agg(F.count(F.lit(1)).alias("w")).withColumn("dst", _above("host")).filter("dst IS NOT NULL")
    counted = links.filter("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    up = up.select(F.col("host").alias("src"), "dst", "w")
    both = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return counted.unionByName(both).groupBy("src", "dst").agg(F.sum("w").cast("double").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` rounds; ``seeds`` is (host,
    trust, distrust) with both columns summing to 1 (or 0). Mass at a host
    without outgoing edges is dropped."""
    out = edges.groupBy("src").agg(F.sum("w").alias("out")).withColumnRenamed("src", "s")
    into = edges.groupBy("dst").agg(F.sum("w").alias("into")).withColumnRenamed("dst", "d")
    shares = edges.join(out, F.col("src") == F.col("s")).join(into, F.col("dst") == F.col("d"))
    shares = staged(shares.select("src", "dst", (F.col("w") / F.col("out")).alias("f"), (F.col("w") / F.col("into")).alias("b")), "op4-edges")
    start = seeds.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust"))
    scores, zero = seeds, F.lit(0.0)
    for k in range(1, rounds + 1):
        ahead = shares.join(scores.filter("trust > 0"), F.col("src") == F.col("host"))
        back = shares.join(scores.filter("distrust > 0"), F.col("dst") == F.col("host"))
        scores = (
            start.unionByName(ahead.select(F.col("dst").alias("host"), (F.col("trust") * F.col("f") * damping).alias("trust"), zero.alias("distrust")))
            .unionByName(back.select(F.col("src").alias("host"), zero.alias("trust"), (F.col("distrust") * F.col("b") * damping).alias("distrust")))
            .groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        )
        if k % STEP == 0 or k == rounds:
            scores = staged(scores, "op4-scores")
    return scores


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row: page_id, host, path, rule, verdict, trust, distrust.

    Null urls and urls without ``://`` have an empty host and path and no
    rule. Hosts that neither trust nor distrust reaches, the empty one among
    them, are allowed. Repeated rows each count and are each judged; an empty
    table gives an empty result.
    """
    base = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), host_of(F.col(f"`{url_col}`")).alias("host"),
        path_of(F.col(f"`{url_col}`")).alias("path"), F.col(f"`{html_col}`").alias("html"),
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = base.withColumn("rule", rule).withColumn("ruled", verdict)
    n = lambda v: F.count(F.when(F.col("ruled") == v, 1)).cast("double")
    seeds = staged(ruled.filter("host <> '' AND ruled IS NOT NULL").groupBy("host").agg(n("allow").alias("a"), n("block").alias("b")), "op4-seeds")
    total = seeds.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    seeds = seeds.select(
        "host", (F.col("a") / F.lit(total.a or 1.0)).alias("trust"), (F.col("b") / F.lit(total.b or 1.0)).alias("distrust")
    )
    edges = staged(host_edges(base), "op4-host-edges")
    scores = propagate(edges, seeds, rounds=rounds).withColumnRenamed("host", "h")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    own = F.when(distrust > threshold * trust, "block").otherwise("allow")
    return ruled.drop("html").join(scores, F.col("host") == F.col("h"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(load(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def oracle(rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = ROUNDS) -> str:
    """The same in DuckDB, the rounds written out."""
    by_length = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in by_length]
    case = lambda k: "CASE " + " ".join(f"WHEN {f} THEN '{(r[1] + r[2], r[0])[k]}'" for f, r in zip(fits, by_length)) + " END"
    lower = lambda c: f"translate({c}, '{UPPER}', '{LOWER}')"
    link = LINK.replace("'", "''")
    ctes = [f"""
p AS MATERIALIZED (SELECT page_id, html, {lower(f"coalesce(regexp_extract(url, '{URL}', 1), '')")} AS host, coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
r AS MATERIALIZED (SELECT page_id, host, path, {case(0)} AS rule, {case(1)} AS ruled FROM p),
seen AS (SELECT host, count(*) AS w, nullif(regexp_extract(host, '^[^.]+\\.(.+\\..+)$', 1), '') AS up FROM p WHERE host <> '' GROUP BY host),
raw AS (SELECT src, {lower("dst")} AS dst, 1 AS w FROM (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS dst FROM p WHERE host <> '')
 UNION ALL SELECT host, up, w FROM seen WHERE up IS NOT NULL UNION ALL SELECT up, host, w FROM seen WHERE up IS NOT NULL),
e0 AS (SELECT src, dst, sum(w) AS w FROM raw WHERE src <> dst GROUP BY ALL),
e AS MATERIALIZED (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS f, w / sum(w) OVER (PARTITION BY dst) AS b FROM e0),
s0 AS MATERIALIZED (SELECT host, count(*) FILTER (ruled = 'allow') / nullif(sum(count(*) FILTER (ruled = 'allow')) OVER (), 0) AS t, count(*) FILTER (ruled = 'block') / nullif(sum(count(*) FILTER (ruled = 'block')) OVER (), 0) AS d FROM r WHERE host <> '' AND ruled IS NOT NULL GROUP BY host)"""]
    for k in range(1, rounds + 1):
        ctes.append(f"""s{k} AS MATERIALIZED (SELECT host, sum(t) AS t, sum(d) AS d FROM (
 SELECT host, coalesce(t, 0) * {1 - DAMPING} AS t, coalesce(d, 0) * {1 - DAMPING} AS d FROM s0
 UNION ALL SELECT e.dst, t * f * {DAMPING}, 0 FROM e JOIN s{k - 1} s ON e.src = s.host WHERE t > 0
 UNION ALL SELECT e.src, 0, d * b * {DAMPING} FROM e JOIN s{k - 1} s ON e.dst = s.host WHERE d > 0) GROUP BY host)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT page_id, r.host AS host, path, rule,
 coalesce(ruled, CASE WHEN coalesce(d, 0) > {THRESHOLD} * coalesce(t, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN s{rounds} s ON r.host = s.host"""


ORACLE_OP4 = oracle()
