"""Column -> Column building blocks shared by every cleaning rule.

All of them are built-in Catalyst expressions, so a rule stays inside
whole-stage codegen, and none of them can raise at run time: they give the
same answer whether ``spark.sql.ansi.enabled`` is on or off.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must match the source rules exactly).
DEFAULT_MISSING_STRING = "Unknown"
DEFAULT_OTHER = "Other"
INVOICE_DATE_FORMAT = "dd-MM-yyyy"
# Shape every string that INVOICE_DATE_FORMAT can parse has: two-digit day and
# month, a year of four or more digits with an optional sign. Checking it
# first skips the parser, which raises and catches internally for every
# string that does not fit (tests/test_functions.py checks the equivalence).
INVOICE_DATE_SHAPE = r"^\d{2}-\d{2}-[+-]?\d{4,}$"
SPECIAL_CHARACTERS = "[^a-zA-Z0-9\\s]"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)

# Whitespace a legacy cast trims (every character up to the space).
_WS = r"[\x00-\x20]"
_FRACTION = rf"^({_WS}*[+-]?\d+)\.\d*({_WS}*)$"
_BARE_FRACTION = rf"^{_WS}*[+-]?\.\d*{_WS}*$"

_INT_BOUNDS = {
    T.IntegerType: (-(2**31), 2**31 - 1),
    T.LongType: (-(2**63), 2**63 - 1),
}


def is_missing_string(c: Column, dtype: T.DataType | None = None) -> Column:
    """NULL or the empty string: both mean "missing" for text columns.

    On a non-text column only NULL counts (comparing it with '' would need a
    cast that raises under ANSI).
    """
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.isNull()
    return c.isNull() | (c == F.lit(""))


def is_missing_number(c: Column, dtype: T.DataType) -> Column:
    """NULL, or NaN for floating-point columns.

    ``isnan`` is applied only to float/double: on a string column it would
    need an implicit cast that raises under ANSI.
    """
    if isinstance(dtype, _FRACTIONAL):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def fill_string(
    c: Column, default: str = DEFAULT_MISSING_STRING, dtype: T.DataType | None = None
) -> Column:
    # A non-text column becomes text (legacy coercion); ANSI coercion would
    # instead try to turn the default into a number and fail.
    other = c if dtype is None or isinstance(dtype, T.StringType) else c.cast(T.StringType())
    return F.when(is_missing_string(c, dtype), F.lit(default)).otherwise(other)


def fill_number(
    c: Column, dtype: T.DataType, default: float | int = 0.0, keep_type: bool = False
) -> Column:
    """Replace NULL/NaN with ``default``.

    The default's own type takes part in type coercion, so an integer column
    filled with ``0.0`` becomes DOUBLE (this is the observable behaviour of the
    sales flow). ``keep_type=True`` casts the default to the column type first.
    """
    value = F.lit(default).cast(dtype) if keep_type else F.lit(default)
    return F.when(is_missing_number(c, dtype), value).otherwise(c)


def standardise(c: Column, allowed: Iterable[str], other: str = DEFAULT_OTHER) -> Column:
    """``upper(trim(c))`` when it is one of ``allowed``, else ``other``.

    NULL is not in any list, so it maps to ``other`` too.
    """
    u = F.upper(F.trim(c))
    return F.when(u.isin(list(allowed)), u).otherwise(F.lit(other))


def strip_special(c: Column) -> Column:
    """Trim, then drop every character outside ASCII letters, digits and
    whitespace. The result is not re-trimmed."""
    return F.regexp_replace(F.trim(c), SPECIAL_CHARACTERS, "")


def replace_where(c: Column, predicate: Column, value) -> Column:
    """``value`` where ``predicate`` holds, else the column (NULL predicate
    keeps the column)."""
    return F.when(predicate, F.lit(value)).otherwise(c)


def parse_date(c: Column, fmt: str = INVOICE_DATE_FORMAT, iso_fallback: bool = True) -> Column:
    """Parse a text date in ``fmt``; optionally fall back to the ISO cast.

    ``try_to_date`` is strict (``5-8-2022`` and ``31-02-2022`` are NULL) and
    never raises. The fallback accepts what ``CAST(x AS DATE)`` accepts.
    """
    parsed = F.try_to_date(c, fmt)
    if fmt == INVOICE_DATE_FORMAT:
        parsed = F.when(c.rlike(INVOICE_DATE_SHAPE), parsed)
    if iso_fallback:
        return F.coalesce(parsed, c.try_cast(T.DateType()))
    return parsed


def _string_to_integral(c: Column, target: T.DataType) -> Column:
    # Legacy (non-ANSI) casts drop a fractional part that directly follows
    # the digits: '2.7' -> 2, ' 41.7 ' -> 41, '2.' -> 2, and a bare fraction
    # such as '.5' is 0; '7 .5' stays invalid. try_cast alone gives NULL for
    # all of them. Text without a '.' needs neither regex (the common case).
    whole = F.regexp_replace(c, _FRACTION, "$1$2")
    return (
        F.when(~c.contains("."), c.try_cast(target))
        .when(c.rlike(_BARE_FRACTION), F.lit(0).cast(target))
        .otherwise(whole.try_cast(target))
    )


_WIDTH = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _wrap(c: Column, target: T.DataType) -> Column:
    """Keep the low bits of an integral value, as a legacy narrowing cast
    does (bit masks, so nothing can overflow under ANSI)."""
    bits = _WIDTH[type(target)]
    low = c.cast(T.LongType()).bitwiseAND(F.lit((1 << bits) - 1))
    signed = F.when(low >= F.lit(1 << (bits - 1)), low - F.lit(1 << bits)).otherwise(low)
    return signed.cast(target)


def _fractional_to_integral(c: Column, target: T.DataType) -> Column:
    # Legacy casts send NaN to 0 and saturate at the int/long bounds; narrower
    # types take the low bits of the saturated int.
    bounds = _INT_BOUNDS.get(type(target))
    if bounds is None:
        return _wrap(_fractional_to_integral(c, T.IntegerType()), target)
    lo, hi = bounds
    return (
        F.when(F.isnan(c), F.lit(0).cast(target))
        .when(c >= F.lit(float(hi)), F.lit(hi).cast(target))
        .when(c <= F.lit(float(lo)), F.lit(lo).cast(target))
        .otherwise(c.try_cast(target))
    )


def lenient_cast(
    c: Column,
    source: T.DataType,
    target: T.DataType,
    date_format: str | None = None,
) -> Column:
    """Cast that turns bad values into NULL instead of failing the job.

    Matches the legacy (ANSI off) cast on the inputs seen in bronze data,
    independent of the session's ANSI setting. ``date_format`` makes a
    string -> date cast parse that format first and fall back to ISO.
    """
    if source == target:
        return c
    if isinstance(source, T.StringType):
        if isinstance(target, _INTEGRAL):
            return _string_to_integral(c, target)
        if isinstance(target, T.DateType) and date_format:
            return parse_date(c, date_format, iso_fallback=True)
        return c.try_cast(target)
    if isinstance(source, _FRACTIONAL) and isinstance(target, _INTEGRAL):
        return _fractional_to_integral(c, target)
    if (
        isinstance(source, _INTEGRAL)
        and isinstance(target, _INTEGRAL)
        and _WIDTH[type(target)] < _WIDTH[type(source)]
    ):
        return _wrap(c, target)
    return c.try_cast(target)
