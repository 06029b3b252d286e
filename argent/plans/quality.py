"""Data-quality reports: the counters a data owner wants, as result tables.

Each counter is taken *at its position in the flow* (for example invalid
quantities are counted after missing ones were filled with 0.0, so they
count too). ``customer_quality`` / ``sales_quality`` compute all of them in
one job: one scan, one shuffle on the entity key with map-side partial
aggregation, then a one-row global aggregate. Only counts cross the shuffle:
quantity and price are never NULL after the fill, and customer_id leads the
dedup order (ascending, NULLS FIRST, '' before other text), so the kept row of
an invoice lacks a customer exactly when some row of that invoice does.

``observed_*_pipeline`` return the pipeline plus an ``Observation``, so that the
counters are filled as a by-product of the single write action. Counts travel
with the rows: the dedup aggregate adds up each key's rows and flags, and the
observation sums them after the shuffle, in the stage that writes. Spark takes a
result task's metrics once, however often a stage before it is run again, so
these counters are as exact as the reports. (Only a further shuffle between the
pipeline and the write would move the sum out of the last stage.)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from argent.functions.exprs import is_missing_string
from argent.operators.customers import (
    age_invalid,
    clean_gender,
    customer_valid,
    gender_invalid,
    validate_age,
)
from argent.operators.sales import (
    category_invalid,
    clean_category,
    clean_mall_names,
    parse_invoice_date,
    price_invalid,
    quantity_invalid,
    sale_valid,
    validate_numeric_fields,
)
from argent.operators.stages import col, first_of_each
from argent.plans.pipelines import customer_prepare, preferred, sales_prepare
from argent.schemas import KEY, CustomerColumns, Entity, SalesColumns

_N = "__argent_n"
_NO_CUSTOMER = "no_customer"

CUSTOMER_ROW_COUNTERS = ("invalid_genders", "invalid_ages")
SALES_ROW_COUNTERS = ("null_invoice_dates", "invalid_quantities", "invalid_prices", "invalid_categories")
CUSTOMER_COUNTERS = (
    "rows_in",
    "invalid_genders",
    "invalid_ages",
    "duplicates_removed",
    "invalid_customers",
    "rows_out",
)
SALES_COUNTERS = (
    "rows_in",
    "duplicates_removed",
    "null_invoice_dates",
    "invalid_quantities",
    "invalid_prices",
    "invalid_categories",
    "invalid_sales",
    "rows_out",
)


def flag(name: str) -> str:
    return f"__argent_flag_{name}"


def customer_flagged(df: DataFrame, c: CustomerColumns, also: Sequence[str] = ()) -> DataFrame:
    """The customer flow up to the dedup, with one boolean per row counter
    evaluated where the rule sees the data, and the ``also`` columns."""
    out = customer_prepare(df, c, also)
    out = out.withColumn(flag("invalid_genders"), gender_invalid(col(c.gender)))
    out = clean_gender(out, c.gender)
    out = out.withColumn(flag("invalid_ages"), age_invalid(col(c.age)))
    return validate_age(out, c.age)


def sales_flagged(df: DataFrame, c: SalesColumns, date_mode: str, also: Sequence[str] = ()) -> DataFrame:
    out = sales_prepare(df, c, date_mode, also)
    out = out.withColumn(flag("null_invoice_dates"), col(c.invoice_date).isNull())
    out = parse_invoice_date(out, c.invoice_date)
    out = out.withColumns(
        {
            flag("invalid_quantities"): quantity_invalid(col(c.quantity)),
            flag("invalid_prices"): price_invalid(col(c.price)),
        }
    )
    out = validate_numeric_fields(out, c)
    out = out.withColumn(flag("invalid_categories"), category_invalid(col(c.category)))
    out = clean_category(out, c.category)
    return clean_mall_names(out, c.shopping_mall)


def _counts(row_counters: Sequence[str]) -> list[Column]:
    """A key's rows, and those of them that each counter counts."""
    return [F.count(F.lit(1)).alias(_N), *(F.count_if(F.col(flag(k))).alias(flag(k)) for k in row_counters)]


def _totals(row_counters: Sequence[str], valid: Column, invalid_name: str) -> dict[str, Column]:
    """The counters as aggregates over keys. ``valid`` judges a key."""
    valid = F.coalesce(valid, F.lit(False))
    rows_in = F.coalesce(F.sum(_N), F.lit(0)).cast("bigint")
    aggs = {k: F.coalesce(F.sum(flag(k)), F.lit(0)).cast("bigint") for k in row_counters}
    return aggs | {
        "rows_in": rows_in,
        "duplicates_removed": rows_in - F.count(F.lit(1)),
        invalid_name: F.count_if(~valid),
        "rows_out": F.count_if(valid),
    }


def _report(
    flagged: DataFrame, keys: list[str], row_counters: tuple[str, ...], valid: Column, invalid_name: str
) -> tuple[DataFrame, dict[str, Column]]:
    """Per-key counts, then one global row. ``valid`` judges a key from its
    columns and its counts."""
    per_key = flagged.groupBy(*[col(k) for k in keys]).agg(*_counts(row_counters))
    return per_key, _totals(row_counters, valid, invalid_name)


def customer_quality(df: DataFrame, columns: Entity | None = None) -> DataFrame:
    """One row: rows_in, invalid_genders, invalid_ages, duplicates_removed,
    invalid_customers, rows_out (all BIGINT)."""
    c = columns or CustomerColumns()
    per_key, aggs = _report(
        customer_flagged(df, c), c.having(KEY), CUSTOMER_ROW_COUNTERS, customer_valid(col(c.customer_id)), "invalid_customers"
    )
    return per_key.agg(*[aggs[k].alias(k) for k in CUSTOMER_COUNTERS])


def sales_quality(
    df: DataFrame, columns: Entity | None = None, date_mode: str = "parse_first", keep: str = "first"
) -> DataFrame:
    """One row: rows_in, duplicates_removed, null_invoice_dates,
    invalid_quantities, invalid_prices, invalid_categories, invalid_sales,
    rows_out (all BIGINT)."""
    c = columns or SalesColumns()
    flagged = sales_flagged(df, c, date_mode).withColumn(flag(_NO_CUSTOMER), is_missing_string(col(c.customer_id)))
    lacking = F.col(flag(_NO_CUSTOMER)) < F.col(_N) if preferred(keep, F.lit(True)) is not None else F.col(flag(_NO_CUSTOMER)) == 0
    valid = ~is_missing_string(col(c.invoice_no)) & lacking
    per_key, aggs = _report(flagged, c.having(KEY), (*SALES_ROW_COUNTERS, _NO_CUSTOMER), valid, "invalid_sales")
    return per_key.agg(*[aggs[k].alias(k) for k in SALES_COUNTERS])


@dataclass
class PipelineObservations:
    """Counters filled by the first action on the observed pipeline. Rows are
    counted between dedup and filter, so rows without a key cross the shuffle
    (one per key and map task)."""

    seen: Observation
    names: tuple[str, ...]

    def report(self) -> dict[str, int]:
        got = self.seen.get
        return {k: got[k] for k in self.names}


def _observe_flow(
    flagged: DataFrame, keys: list[str], row_counters: tuple[str, ...], valid: Column, first: Column | None,
    invalid_name: str, names: tuple[str, ...],
) -> tuple[DataFrame, PipelineObservations]:
    seen = Observation()
    rows = first_of_each(flagged, keys, first, _counts(row_counters), aside=[flag(k) for k in row_counters])
    valid = F.coalesce(valid, F.lit(False))
    aggs = _totals(row_counters, valid, invalid_name)
    rows = rows.observe(seen, *(aggs[k].alias(k) for k in names))
    out = rows.filter(valid).drop(_N, *(flag(k) for k in row_counters))
    return out, PipelineObservations(seen, names)


def observed_customer_pipeline(
    df: DataFrame, columns: Entity | None = None
) -> tuple[DataFrame, PipelineObservations]:
    c = columns or CustomerColumns()
    return _observe_flow(
        customer_flagged(df, c), c.having(KEY), CUSTOMER_ROW_COUNTERS, customer_valid(col(c.customer_id)), None,
        "invalid_customers", CUSTOMER_COUNTERS,
    )


def observed_sales_pipeline(
    df: DataFrame, columns: Entity | None = None, date_mode: str = "parse_first", keep: str = "first"
) -> tuple[DataFrame, PipelineObservations]:
    c = columns or SalesColumns()
    valid = sale_valid(c)
    return _observe_flow(
        sales_flagged(df, c, date_mode), c.having(KEY), SALES_ROW_COUNTERS, valid, preferred(keep, valid),
        "invalid_sales", SALES_COUNTERS,
    )
