"""All queries of the matching engine and their SQL counterparts."""

from __future__ import annotations

from .plans import answers, cells, files, keywords, lookups, payloads, reports, retrieval, selection, streams  # noqa: F401  (they register their queries)
from .plans.registry import ORACLE_SQL, QUERIES

FLAGSHIP = "hybrid_recommend"
__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
