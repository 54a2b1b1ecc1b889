"""All queries over the driver's tables, with their SQL."""

from __future__ import annotations

from siftspark.plans import join_queries, payload_queries, release_queries, selection_queries, structure_queries, text_queries  # noqa: F401  they register their queries
from siftspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
