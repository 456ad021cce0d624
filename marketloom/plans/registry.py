"""All registered queries of the library."""

from __future__ import annotations

from marketloom.plans import feature_queries, policy_queries, quality_queries  # noqa: F401
from marketloom.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
