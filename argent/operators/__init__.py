"""DataFrame -> DataFrame stages and the entity rules built on them."""

from argent.operators.customers import (
    clean_gender,
    clean_names,
    validate_age,
    validate_customers,
)
from argent.operators.sales import (
    clean_category,
    clean_mall_names,
    parse_invoice_date,
    validate_numeric_fields,
    validate_sales,
)
from argent.operators.stages import conform, dedup, fill_missing, trim_strings

__all__ = [
    "clean_category",
    "clean_gender",
    "clean_mall_names",
    "clean_names",
    "conform",
    "dedup",
    "fill_missing",
    "parse_invoice_date",
    "trim_strings",
    "validate_age",
    "validate_customers",
    "validate_numeric_fields",
    "validate_sales",
]
