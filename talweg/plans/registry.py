"""Queries of the engine's own operators, and their SQL."""

from __future__ import annotations

from talweg.plans import builders, enrich, models, network, relational, spatial

_PLANS = (models, spatial, network, relational, builders, enrich)
QUERIES = {name: query for plan in _PLANS for name, query in plan.QUERIES.items()}
ORACLE_SQL = {name: sql for plan in _PLANS for name, sql in plan.ORACLE_SQL.items()}
FLAGSHIP = "freight_unit_cost"
