"""Column expressions used by the cleaning rules."""

from argent.functions.exprs import (
    DEFAULT_MISSING_STRING,
    DEFAULT_OTHER,
    INVOICE_DATE_FORMAT,
    SPECIAL_CHARACTERS,
    fill_number,
    fill_string,
    is_missing_number,
    is_missing_string,
    lenient_cast,
    parse_date,
    replace_where,
    standardise,
    strip_special,
)

__all__ = [
    "DEFAULT_MISSING_STRING",
    "DEFAULT_OTHER",
    "INVOICE_DATE_FORMAT",
    "SPECIAL_CHARACTERS",
    "fill_number",
    "fill_string",
    "is_missing_number",
    "is_missing_string",
    "lenient_cast",
    "parse_date",
    "replace_where",
    "standardise",
    "strip_special",
]
