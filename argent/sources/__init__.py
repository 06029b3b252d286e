"""File scans and table-level source checks."""

from argent.sources.scans import (
    read_csv,
    read_csv_validated,
    read_parquet,
    read_parquet_validated,
    require_columns,
    require_rows,
    route_bad_records,
)

__all__ = [
    "read_csv",
    "read_csv_validated",
    "read_parquet",
    "read_parquet_validated",
    "require_columns",
    "require_rows",
    "route_bad_records",
]
