"""All queries of the engine, by name, with their SQL for DuckDB."""

from __future__ import annotations

from corpuslens.plans import cells, composition, labels, records, relational, release, repair, review, scalar  # noqa: F401
from corpuslens.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
