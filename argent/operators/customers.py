"""Customer rules: gender, age, names, row filter."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argent.functions.exprs import standardise, strip_special
from argent.operators.stages import col

log = logging.getLogger(__name__)

# Fixed values (must match the source rules exactly).
GENDERS = ["MALE", "FEMALE"]
AGE_MIN = 0
AGE_MAX = 120
AGE_REPLACEMENT = 0


def gender_invalid(c: Column) -> Column:
    """Row predicate counted as "invalid gender" (NULL stays NULL)."""
    return ~F.upper(F.trim(c)).isin(GENDERS)


def clean_gender(df: DataFrame, column: str = "gender") -> DataFrame:
    """MALE/FEMALE in any case and padding -> upper case; anything else,
    NULL and '' included, -> 'Other'. An absent column leaves ``df`` as is."""
    if column not in df.columns:
        log.warning("Gender column %r not found in DataFrame", column)
        return df
    return df.withColumn(column, standardise(col(column), GENDERS))


def age_invalid(c: Column) -> Column:
    return c.isNull() | (c < AGE_MIN) | (c > AGE_MAX)


def validate_age(df: DataFrame, column: str = "age") -> DataFrame:
    """NULL, negative or > 120 -> 0; the bounds themselves are valid."""
    return df.withColumn(
        column, F.when(age_invalid(col(column)), F.lit(AGE_REPLACEMENT)).otherwise(col(column))
    )


def clean_names(df: DataFrame, name_columns: Sequence[str]) -> DataFrame:
    """Strip special characters from each present name column; absent
    names are skipped silently."""
    present = [n for n in name_columns if n in df.columns]
    if not present:
        return df
    return df.withColumns({n: strip_special(col(n)) for n in present})


def customer_valid(id_col: Column) -> Column:
    """Id not NULL, not '' and not blank. ``trim(NULL) != ''`` is NULL, so a
    single comparison covers all three."""
    return F.trim(id_col) != F.lit("")


def validate_customers(df: DataFrame, id_column: str = "customer_id") -> DataFrame:
    return df.filter(customer_valid(col(id_column)))
