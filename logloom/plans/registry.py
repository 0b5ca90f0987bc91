"""Every query of the library by name, and the SQL that gives the same rows."""

from __future__ import annotations

from logloom.plans import languages, profile_queries, records, reward_queries, structure_queries, token_queries, wide  # noqa: F401 - they register their queries
from logloom.plans.queries import ORACLE, QUERIES

FLAGSHIP = "weekly_active_signals"

__all__ = ["FLAGSHIP", "ORACLE", "QUERIES"]
