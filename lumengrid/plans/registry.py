"""All queries of the engine and their DuckDB oracles."""

from __future__ import annotations

from . import catalog

QUERIES, ORACLES, FLAGSHIP = catalog.QUERIES, catalog.ORACLES, catalog.flagship
