"""Sales rules: invoice date, numeric ranges, category, mall names, row
filter."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.functions.exprs import (
    INVOICE_DATE_FORMAT,
    is_missing_string,
    parse_date,
    replace_where,
    standardise,
    strip_special,
)
from argent.operators.stages import col
from argent.schemas import REQUIRED, TEXT, Entity, SalesColumns

# Fixed values (must match the source rules exactly).
CATEGORIES = [
    "CLOTHING",
    "SHOES",
    "BOOKS",
    "COSMETICS",
    "FOOD & BEVERAGE",
    "ELECTRONICS",
    "ACCESSORIES",
]
MIN_QUANTITY = 1
MIN_PRICE = 0.0


def parse_invoice_date(
    df: DataFrame,
    column: str = "invoice_date",
    fmt: str = INVOICE_DATE_FORMAT,
    iso_fallback: bool = False,
) -> DataFrame:
    """Text dates in ``fmt`` -> DATE (NULL when unparseable, ISO dates
    included unless ``iso_fallback``). A DATE column is left as is; a timestamp
    keeps its date part."""
    dtype = df.schema[column].dataType
    c = col(column)
    if isinstance(dtype, T.DateType):
        return df
    if isinstance(dtype, T.StringType):
        parsed = parse_date(c, fmt, iso_fallback)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        parsed = F.to_date(c)
    else:
        parsed = c.try_cast(T.DateType())
    return df.withColumn(column, parsed)


def quantity_invalid(c: Column) -> Column:
    return c <= F.lit(0)


def price_invalid(c: Column) -> Column:
    # NaN is not < 0 in Spark's ordering, so NaN prices are kept as they are.
    return c < F.lit(0)


def validate_numeric_fields(df: DataFrame, columns: Entity | None = None) -> DataFrame:
    """quantity <= 0 -> 1, price < 0 -> 0.0; NULLs stay NULL."""
    cols = columns or SalesColumns()
    q, p = col(cols.quantity), col(cols.price)
    return df.withColumns(
        {
            cols.quantity: replace_where(q, quantity_invalid(q), MIN_QUANTITY),
            cols.price: replace_where(p, price_invalid(p), MIN_PRICE),
        }
    )


def category_invalid(c: Column) -> Column:
    return ~F.upper(F.trim(c)).isin(CATEGORIES)


def clean_category(df: DataFrame, column: str = "category") -> DataFrame:
    return df.withColumn(column, standardise(col(column), CATEGORIES))


def clean_mall_names(df: DataFrame, column: str = "shopping_mall") -> DataFrame:
    return df.withColumn(column, strip_special(col(column)))


def sale_valid(columns: Entity | None = None, row=None) -> Column:
    """Every required column present, text also non-empty. ``row`` maps a column name to a Column (defaults to ``col``).
    Blank ids are not trimmed here: the pipeline trims earlier."""
    cols = columns or SalesColumns()
    get = row or col
    text = set(cols.having(TEXT))
    return reduce(
        and_, (~(is_missing_string(get(n)) if n in text else get(n).isNull()) for n in cols.having(REQUIRED))
    )


def validate_sales(df: DataFrame, columns: Entity | None = None) -> DataFrame:
    return df.filter(sale_valid(columns))
