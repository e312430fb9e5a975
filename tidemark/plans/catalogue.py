"""All queries but those of subpackages that may be absent."""

from __future__ import annotations

from . import clarity_queries, overlay_queries, quality_queries, review_queries, space_queries, table_queries, warp_queries
from .registry import QUERIES, SQL, Query

MODULES = (clarity_queries, overlay_queries, quality_queries, review_queries, space_queries, table_queries, warp_queries)


def queries() -> dict[str, Query]:
    return dict(sorted(QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    return dict(sorted(SQL.items()))
