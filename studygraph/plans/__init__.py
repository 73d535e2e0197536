"""The registered queries over the driver's tables; importing a module of this package registers its queries."""

from __future__ import annotations

from studygraph.plans import catalogues, checks, clinical, compare, day_notes, diagrams, entities, extractors, graphs, labels, merges, models, nested, pages, schedules, structures
from studygraph.registry import ORACLES, QUERIES, Query

__all__ = ["catalogues", "checks", "clinical", "compare", "day_notes", "diagrams", "entities", "extractors", "graphs", "labels", "merges", "models", "nested", "oracle_sql", "pages", "queries", "schedules", "structures"]


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
