"""All registered queries of the library and their DuckDB SQL."""

from __future__ import annotations

from . import lifecycle, lifecycle_oracles, oracles, queries

QUERIES = queries.QUERIES | lifecycle.QUERIES
ORACLES = oracles.ORACLES | lifecycle_oracles.ORACLES
