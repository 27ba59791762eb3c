"""All core queries and their SQL."""

from __future__ import annotations

from sedgeline.plans import cells, helpers, problems, relations, shapes, structure

MODULES = [problems, cells, relations, shapes, structure, helpers]
FLAGSHIP = "body_status_fan_in"


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
