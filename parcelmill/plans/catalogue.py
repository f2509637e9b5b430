"""All registered queries and their checks."""

from __future__ import annotations

from parcelmill.plans import access_queries, market_queries, model_queries, profile_queries  # noqa: F401
from parcelmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
