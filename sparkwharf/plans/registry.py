"""All named queries over the driver tables, each with its reference SQL where SQL can state it."""

from __future__ import annotations

from sparkwharf.plans import aggregates, endpoints, feeds, formats, functions, gridded, health, history, joins, modes, positions, shapes, upkeep  # noqa: F401
from sparkwharf.plans.register import QUERIES, SQL, query, table

FLAGSHIP = "g1_trail_day"
__all__ = ["FLAGSHIP", "QUERIES", "SQL", "query", "table"]
