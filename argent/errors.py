"""Error types raised by the library.

Every error keeps its cause (``raise ... from e``) so the Spark condition
that triggered it (for example ``PATH_NOT_FOUND``) stays inspectable.
"""

from __future__ import annotations


class ETLError(Exception):
    """Root of all errors raised by this package."""


class ExtractionError(ETLError):
    """A source could not be read or failed a table-level check."""


class ProcessingError(ETLError):
    """A cleaning stage or pipeline could not be planned."""


class LoadingError(ETLError):
    """A sink refused or failed to write."""
