"""Every registered query of the evidence and inventory operators, with its DuckDB twin."""

from __future__ import annotations

from .registry import ORACLE, QUERIES
from . import evidence, frontier, inventory, pages, records, streams  # noqa: F401,E402  they register their queries

__all__ = ["ORACLE", "QUERIES"]
