"""Hot keys: a key holding a third of all rows crosses the shuffle at most
once per map partition (read from the exchange's metrics after the run)."""

from pyspark.sql import functions as F

from argent.operators.stages import dedup
from argent.plans.quality import sales_quality

ROWS = 300_000
PARTS = 8


def _nodes(plan):
    """Walk a JVM physical plan, descending into adaptive and stage nodes."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
        return
    yield plan
    if name.endswith("QueryStage"):
        yield from _nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _shuffle_records(df) -> int:
    plan = df._jdf.queryExecution().executedPlan()
    total = 0
    for node in _nodes(plan):
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
    return total


def _skewed(spark):
    # A third of the rows have key NULL, a third key "hot", a third are unique.
    ids = spark.range(0, ROWS, numPartitions=PARTS)
    key = (F.when(F.col("id") % 3 == 0, F.lit(None).cast("string"))
           .when(F.col("id") % 3 == 1, F.lit("hot"))
           .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))))
    return ids.select(key.alias("invoice_no"), (F.col("id") % 97).cast("string").alias("v"))


def test_dedup_hot_keys_cross_shuffle_once_per_partition(spark):
    out = dedup(_skewed(spark), ["invoice_no"])
    rows = out.collect()
    unique = ROWS // 3
    assert len(rows) == unique + 2
    kept = {r.invoice_no: r.v for r in rows if r.invoice_no in (None, "hot")}
    assert kept == {None: "0", "hot": "0"}  # smallest v of each hot key
    # Without the partial limit, 2/3 of all rows would cross for the hot keys.
    assert unique <= _shuffle_records(out) <= unique + 2 * PARTS


def test_quality_report_hot_keys_combine_before_shuffle(spark):
    df = _skewed(spark).select(
        "invoice_no",
        F.lit("C1").alias("customer_id"),
        F.lit("Books").alias("category"),
        F.lit("1").alias("quantity"),
        F.lit("1.0").alias("price"),
        F.lit("01-01-2022").alias("invoice_date"),
        F.lit("Mall").alias("shopping_mall"),
    )
    rep = sales_quality(df)
    r = rep.collect()[0]
    assert r.rows_in == ROWS and r.rows_out == ROWS // 3 + 1  # "hot" is valid, NULL is not
    assert r.duplicates_removed == ROWS - (ROWS // 3 + 2)
    # Per-key shuffle plus the one-row gather: hot keys are combined map-side.
    assert ROWS // 3 <= _shuffle_records(rep) <= ROWS // 3 + 2 * PARTS + 64
