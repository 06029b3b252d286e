"""Silver rows and, beside them, every row that failed a rule with its reasons.

A reason is the name of the counter that counts it (``argent.plans.quality``), so
rejects grouped by reason give the quality report. A row that a rule repairs
(a bad age, a missing date) is in silver with the repaired value and among the
rejects as it came; a row that the dedup or the filter removes is among the
rejects alone.

The source is scanned once: its rows go to the shared folder as they came, with a
row number, and are cleaned again whenever they are read. Silver is the aggregate
of the pipeline. For the rejects every row crosses one shuffle, by its key and as it
came; beyond it the rows are cleaned and those of a key numbered, so nothing has to
be joined back. A key with more than ``HOT_ROWS`` rows would be a long task there:
its kept row is found by an aggregate, whose rows combine before the shuffle, its
row number is broadcast, and the key's rows are dealt out by their row numbers.
Only hashes of keys are counted to find such keys, and there are at most
rows / ``HOT_ROWS`` of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.errors import ProcessingError
from argent.operators.customers import customer_valid
from argent.operators.sales import sale_valid
from argent.operators.stages import col, first_of_each
from argent.plans.pipelines import preferred
from argent.plans.quality import CUSTOMER_ROW_COUNTERS, SALES_ROW_COUNTERS, customer_flagged, flag, sales_flagged
from argent.plans.staging import stage_parquet
from argent.schemas import KEY, CustomerColumns, Entity, SalesColumns

DUPLICATE, REASONS = "duplicates_removed", "reasons"
HOT_ROWS = 50_000
_RAW, _ROW, _OK, _KEPT_ROW = "__argent_raw", "__argent_row", "__argent_ok", "__argent_kept_row"
_KEY, _HOT_KEY, _HASH, _N = "__argent_key", "__argent_hot_key", "__argent_hash", "__argent_n"
_SPREAD, _KEPT, _NTH = "__argent_spread", "__argent_kept", "__argent_nth"


@dataclass(frozen=True)
class Split:
    """``silver`` as the pipeline gives it. ``rejects``: the entity's columns as
    they came and ``reasons``, an array of counter names, never empty."""

    silver: DataFrame
    rejects: DataFrame


def _hot(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key more than ``HOT_ROWS`` rows have (or keys of one hash)."""
    hashed = keyed.withColumn(_HASH, F.xxhash64(*map(col, keys)))
    many = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias(_N)).filter(F.col(_N) > HOT_ROWS).select(_HASH)
    path = stage_parquet(many, "hot-keys")
    many = keyed.sparkSession.read.schema(many.schema).parquet(path)
    return hashed.join(F.broadcast(many), _HASH, "left_semi").drop(_HASH)


def _split(df: DataFrame, c: Entity, flagged, counters: tuple[str, ...], valid: Column, first: Column | None, invalid_name: str) -> Split:
    names, keys = [f.name for f in c.schema().fields], c.having(KEY)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ProcessingError(f"Missing columns for schema: {', '.join(sorted(missing))}. Found columns: {', '.join(df.columns)}")

    def cleaned(came: DataFrame, *also: str) -> DataFrame:
        return flagged(came.select(f"{_RAW}.*", _RAW, *also), [_RAW, *also])

    came = df.select(*map(col, names), F.monotonically_increasing_id().alias(_ROW))
    path = stage_parquet(came, "came")
    came = df.sparkSession.read.schema(came.schema).parquet(path).select(F.struct(*map(col, names)).alias(_RAW), _ROW)
    ok = F.coalesce(valid, F.lit(False))
    silver = first_of_each(cleaned(came).select(*map(col, names)), keys, first).filter(ok)

    # Equal cleaned rows are told apart by how they came, then by number.
    keyed = cleaned(came, _ROW).select(*map(col, keys), _RAW, _ROW)
    hot = first_of_each(cleaned(_hot(keyed, keys), _ROW).select(*map(col, names), _RAW, _ROW), keys, first)
    hot = hot.select(*(col(k).alias(f"{_HOT_KEY}{i}") for i, k in enumerate(keys)), F.col(_ROW).alias(_KEPT_ROW))

    # Rows as they came, dealt out by key, those of a hot key by row number.
    same_key = reduce(and_, (col(k).eqNullSafe(F.col(f"{_HOT_KEY}{i}")) for i, k in enumerate(keys)))
    judged = F.col(_KEPT_ROW).isNotNull()
    by = [*(f"{_KEY}{i}" for i in range(len(keys))), _SPREAD]
    dealt = keyed.join(F.broadcast(hot), same_key, "left").select(
        *(col(k).alias(b) for k, b in zip(keys, by)),
        F.when(judged, F.col(_ROW)).alias(_SPREAD),
        F.when(judged, F.col(_ROW) == F.col(_KEPT_ROW)).alias(_KEPT),
        _RAW,
    ).repartition(*by)

    rows = cleaned(dealt, *by, _KEPT).withColumn(_OK, ok)
    later = [] if first is None else [F.coalesce(~first, F.lit(True))]
    order = Window.partitionBy(*by).orderBy(*later, *(col(n) for n in names if n not in keys), _RAW)
    rows = rows.withColumn(_NTH, F.row_number().over(order))
    found = F.array_compact(F.array(*(F.when(F.col(flag(k)), F.lit(k)) for k in counters)))
    kept = F.coalesce(F.col(_KEPT), F.col(_NTH) == 1)
    removed = F.when(~kept, F.array(F.lit(DUPLICATE))).when(~F.col(_OK), F.array(F.lit(invalid_name)))
    reasons = F.concat(found, F.coalesce(removed, F.array().cast("array<string>")))
    rejects = rows.select(_RAW, reasons.alias(REASONS)).filter(F.size(REASONS) > 0)
    return Split(silver, rejects.select(f"{_RAW}.*", REASONS))


def split_customers(df: DataFrame, columns: Entity | None = None) -> Split:
    c = columns or CustomerColumns()
    return _split(
        df, c, lambda x, also: customer_flagged(x, c, also), CUSTOMER_ROW_COUNTERS,
        customer_valid(col(c.customer_id)), None, "invalid_customers",
    )


def split_sales(df: DataFrame, columns: Entity | None = None, date_mode: str = "parse_first", keep: str = "first") -> Split:
    c = columns or SalesColumns()
    valid = sale_valid(c)
    return _split(
        df, c, lambda x, also: sales_flagged(x, c, date_mode, also), SALES_ROW_COUNTERS,
        valid, preferred(keep, valid), "invalid_sales",
    )
