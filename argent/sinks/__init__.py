"""Path and catalog-table sinks with empty, self-overwrite and schema guards."""

from argent.sinks.commit import recover
from argent.sinks.writers import write_keyed_table, write_path, write_table

__all__ = ["recover", "write_keyed_table", "write_path", "write_table"]
