"""SQL equivalents of the registered queries, runnable by DuckDB on the given tables."""

from __future__ import annotations

from sqlcheck import features, quality, reports, scored
from sqlcheck.text import outer


def all_sql() -> dict[str, str]:
    bodies = {**reports.bodies(), **features.bodies(), **quality.bodies(), **scored.bodies()}
    return {key: outer(sql) for key, sql in bodies.items()}
