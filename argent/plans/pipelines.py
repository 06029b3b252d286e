"""Bronze -> silver plans for customers and sales.

Each pipeline is one lazy plan: scan -> one collapsed Project (conform, trim,
fill, rules) -> one dedup shuffle on the entity key -> Filter. Nothing here
triggers a Spark job; callers decide when to act (a write, a count, ...).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from argent.errors import ProcessingError
from argent.functions.exprs import INVOICE_DATE_FORMAT
from argent.operators.customers import clean_gender, validate_age, validate_customers
from argent.operators.sales import (
    clean_category,
    clean_mall_names,
    parse_invoice_date,
    sale_valid,
    validate_numeric_fields,
    validate_sales,
)
from argent.operators.stages import conform, dedup, fill_missing, trim_strings
from argent.schemas import FILLED, KEY, NUMBER, TEXT, CustomerColumns, Entity, SalesColumns

DATE_MODES = ("parse_first", "cast_first")
KEEPS = ("first", "valid_first")


def customer_prepare(df: DataFrame, columns: Entity | None = None, also: Sequence[str] = ()) -> DataFrame:
    """conform -> trim -> fill: the frame the customer rules start from, with
    the columns named in ``also`` as they are."""
    c = columns or CustomerColumns()
    out = conform(df, c.schema(), also=also)
    out = trim_strings(out, c.having(TEXT))
    return fill_missing(
        out,
        string_columns=c.having(FILLED),
        numeric_columns=c.having(NUMBER),
        default_numeric=0,
    )


def customer_rules(df: DataFrame, columns: Entity | None = None) -> DataFrame:
    c = columns or CustomerColumns()
    return validate_age(clean_gender(df, c.gender), c.age)


def customer_clean(df: DataFrame, columns: Entity | None = None) -> DataFrame:
    """Row-wise part of the customer flow (everything before the dedup)."""
    c = columns or CustomerColumns()
    return customer_rules(customer_prepare(df, c), c)


def customer_pipeline(df: DataFrame, columns: Entity | None = None) -> DataFrame:
    """conform -> trim -> fill -> gender -> age -> dedup(customer_id) -> filter."""
    c = columns or CustomerColumns()
    try:
        out = dedup(customer_clean(df, c), c.having(KEY))
        return validate_customers(out, c.customer_id)
    except ProcessingError:
        raise
    except Exception as e:
        raise ProcessingError(f"Failed to process customer data: {e}") from e


def _sales_conform(df: DataFrame, c: SalesColumns, date_mode: str, also: Sequence[str]) -> DataFrame:
    if date_mode not in DATE_MODES:
        raise ProcessingError(f"date_mode must be one of {DATE_MODES}, got {date_mode!r}")
    # parse_first: text dates in dd-MM-yyyy are parsed during the cast, with an
    # ISO fallback. cast_first: a plain cast, which turns dd-MM-yyyy into NULL.
    fmt = INVOICE_DATE_FORMAT if date_mode == "parse_first" else None
    return conform(df, c.schema(), date_format=fmt, also=also)


def sales_prepare(
    df: DataFrame, columns: Entity | None = None, date_mode: str = "parse_first", also: Sequence[str] = ()
) -> DataFrame:
    """conform -> trim -> fill: the frame the sales rules start from, with the
    columns named in ``also`` as they are."""
    c = columns or SalesColumns()
    out = _sales_conform(df, c, date_mode, also)
    out = trim_strings(out, c.having(TEXT))
    return fill_missing(
        out,
        string_columns=c.having(FILLED),
        numeric_columns=c.having(NUMBER),
        default_numeric=0.0,
    )


def sales_rules(df: DataFrame, columns: Entity | None = None) -> DataFrame:
    c = columns or SalesColumns()
    out = parse_invoice_date(df, c.invoice_date)
    out = validate_numeric_fields(out, c)
    out = clean_category(out, c.category)
    return clean_mall_names(out, c.shopping_mall)


def sales_clean(
    df: DataFrame, columns: Entity | None = None, date_mode: str = "parse_first"
) -> DataFrame:
    """Row-wise part of the sales flow (everything before the dedup)."""
    c = columns or SalesColumns()
    return sales_rules(sales_prepare(df, c, date_mode), c)


def preferred(keep: str, valid: Column) -> Column | None:
    """What the dedup looks for first under ``keep``."""
    if keep not in KEEPS:
        raise ProcessingError(f"keep must be one of {KEEPS}, got {keep!r}")
    return valid if keep == "valid_first" else None


def sales_pipeline(
    df: DataFrame, columns: Entity | None = None, date_mode: str = "parse_first", keep: str = "first"
) -> DataFrame:
    """conform -> trim -> fill -> date -> quantity/price -> category -> mall ->
    dedup(invoice_no) -> filter. ``quantity`` leaves as DOUBLE (its fill
    default is 0.0).

    The source flow removes duplicates before it validates, so an invoice whose
    kept row lacks a customer is lost although another row has one;
    ``keep="valid_first"`` keeps a valid row of each invoice if there is one."""
    c = columns or SalesColumns()
    try:
        out = dedup(sales_clean(df, c, date_mode), c.having(KEY), valid=preferred(keep, sale_valid(c)))
        return validate_sales(out, c)
    except ProcessingError:
        raise
    except Exception as e:
        raise ProcessingError(f"Failed to process sales data: {e}") from e
