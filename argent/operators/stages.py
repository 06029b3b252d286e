"""Generic DataFrame -> DataFrame stages: conform, trim, fill, dedup.

Each stage adds at most one projection (``select`` / ``withColumns``), so a
chain of stages collapses into a single Project that Catalyst pushes onto the
scan. Only ``dedup`` shuffles.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.errors import ProcessingError
from argent.functions.exprs import (
    DEFAULT_MISSING_STRING,
    fill_number,
    fill_string,
    lenient_cast,
)

log = logging.getLogger(__name__)

_ROW_NUMBER, _KEPT, _LATER = "__argent_rn", "__argent_kept", "__argent_later"


def quote(name: str) -> str:
    """Backtick-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def _case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def _find_field(
    fields: list[T.StructField], name: str, case_sensitive: bool
) -> T.StructField | None:
    if case_sensitive:
        matches = [f for f in fields if f.name == name]
    else:
        matches = [f for f in fields if f.name.lower() == name.lower()]
    if len(matches) > 1:
        found = ", ".join(f.name for f in matches)
        raise ProcessingError(f"Column {name!r} is ambiguous: {found}")
    return matches[0] if matches else None


def conform(
    df: DataFrame, schema: T.StructType | None, date_format: str | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """Select exactly ``schema``'s columns, in its order, cast leniently, and
    those named in ``also`` as they are.

    Extra columns are dropped (column pruning then reaches the scan); a
    missing column raises ``ProcessingError``. Name lookup follows Spark's
    resolution (case-insensitive by default); the output takes the schema's
    spelling. ``None`` or an empty schema returns ``df`` unchanged.
    """
    if not schema or not schema.fields:
        return df
    exprs: list[Column] = []
    missing: list[str] = []
    fields, case_sensitive = df.schema.fields, _case_sensitive(df)
    for field in schema.fields:
        src = _find_field(fields, field.name, case_sensitive)
        if src is None:
            missing.append(field.name)
            continue
        exprs.append(
            lenient_cast(col(src.name), src.dataType, field.dataType, date_format).alias(
                field.name
            )
        )
    if missing:
        raise ProcessingError(
            f"Missing columns for schema: {', '.join(sorted(missing))}. "
            f"Found columns: {', '.join(df.columns)}"
        )
    return df.select(*exprs, *(col(n) for n in also))


def _present(df: DataFrame, names: Sequence[str], what: str) -> list[str]:
    present = []
    for name in names:
        # Exact-name test, as the rules are configured by exact column name.
        if name in df.columns:
            present.append(name)
        else:
            log.warning("%s column %r not found in DataFrame, skipping", what, name)
    return present


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim spaces from both ends of string columns.

    ``columns=None`` trims every StringType column; otherwise the named ones
    that exist. Only the space character is removed (tabs, newlines and NBSP
    stay), which is Spark's ``trim``.
    """
    if columns is None:
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    else:
        names = _present(df, columns, "String")
    if not names:
        return df
    return df.withColumns({n: F.trim(col(n)) for n in names})


def fill_missing(
    df: DataFrame,
    string_columns: Sequence[str] | None = None,
    numeric_columns: Sequence[str] | None = None,
    default_string: str = DEFAULT_MISSING_STRING,
    default_numeric: float | int = 0.0,
    keep_type: bool = False,
) -> DataFrame:
    """NULL/'' -> ``default_string`` on text; NULL/NaN -> ``default_numeric``.

    With ``keep_type=False`` the numeric default's type widens the column
    (int + 0.0 -> double), as the source flow does.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    updates: dict[str, Column] = {}
    for n in _present(df, string_columns or [], "String"):
        updates[n] = fill_string(col(n), default_string, types[n])
    for n in _present(df, numeric_columns or [], "Numeric"):
        updates[n] = fill_number(col(n), types[n], default_numeric, keep_type)
    return df.withColumns(updates) if updates else df


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def _comparable(field: T.StructField) -> Column:
    """A column's place in the default order: itself, or a map's entries
    sorted by key."""
    c, dtype = col(field.name), field.dataType
    if _orderable(dtype):
        return c
    if isinstance(dtype, T.MapType) and _orderable(dtype.keyType) and _orderable(dtype.valueType):
        return F.array_sort(F.map_entries(c))
    raise ProcessingError(f"Column {field.name!r} cannot be ordered: {dtype.simpleString()}")


def first_of_each(
    df: DataFrame, keys: Sequence[str], valid: Column | None = None, counts: Sequence[Column] = (), aside: Sequence[str] = ()
) -> DataFrame:
    """The smallest row of each key, compared field by field, ascending, NULLS
    FIRST; with ``valid``, rows for which it holds come before all others. An
    aggregate, so rows of a key combine before the shuffle. ``counts`` are
    named aggregates over all rows of the key, added as columns; columns named
    in ``aside`` serve them alone and are no part of the row."""
    rest = [f for f in df.schema.fields if f.name not in {*keys, *aside}]
    if not rest and not counts:
        return df.dropDuplicates(list(keys))
    later = [] if valid is None else [F.coalesce(~valid, F.lit(True)).alias(_LATER)]
    row = F.struct(*later, *[col(f.name) for f in rest]) if rest else F.struct(F.lit(0))
    if all(_orderable(f.dataType) for f in rest):
        least = F.min(row)
    else:
        least = F.min_by(row, F.struct(*later, *[_comparable(f) for f in rest]))
    kept = df.groupBy(*[col(k) for k in keys]).agg(least.alias(_KEPT), *counts)
    added = [n for n in kept.columns if n not in (*keys, _KEPT)]
    return kept.select(
        *[col(n) if n in set(keys) else F.col(_KEPT).getField(n).alias(n) for n in df.columns if n not in set(aside)],
        *map(col, added),
    )


def dedup(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[Column] | None = None,
    valid: Column | None = None,
) -> DataFrame:
    """One row per key; whole-row distinct when ``keys`` is None.

    The kept row is the smallest by its other columns, in schema order,
    ascending, NULLS FIRST (map columns by their sorted entries), so results are
    deterministic; a column that has no order at all raises. It is an
    aggregate: a key holding a third of the table ships one row per map
    partition through the shuffle. With ``order_by`` the first row in that
    order is kept, by a window. NULL keys form one group.
    With ``valid`` a row for which it holds is kept before any other of its key,
    at the same price: it is the first field of the comparison.
    """
    if not keys:
        return df.dropDuplicates()
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ProcessingError(f"Dedup key columns not found: {', '.join(missing)}")
    if order_by is None:
        return first_of_each(df, keys, valid)
    if valid is not None:
        order_by = [F.coalesce(valid, F.lit(False)).desc(), *order_by]
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order_by)
    return (
        df.withColumn(_ROW_NUMBER, F.row_number().over(w))
        .filter(F.col(_ROW_NUMBER) == 1)
        .drop(_ROW_NUMBER)
    )
