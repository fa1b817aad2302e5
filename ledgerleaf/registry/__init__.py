"""Named queries over the driver tables, with the SQL each must agree with.

The modules map the tables onto this package's schemas and call its operators; they add
no logic of their own.
"""

from __future__ import annotations

from . import extraction, ingest, records, reports  # noqa: F401  (each registers its queries)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
