"""Queries over the driver's tables, each with the SQL that recomputes it.

``QUERIES`` maps a name to a function of ``Tables``; ``ORACLES`` maps it to DuckDB SQL.
"""

from sftq.catalog import audit, judge, records, select, shards, text, validate  # noqa: F401
from sftq.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
