"""All registered queries of the engine (importing this module registers them)."""

from __future__ import annotations

from . import archive_queries, catalog_queries, change_queries, listing_queries, metadata_queries, rule_queries, search_queries, structure_queries, text_queries  # noqa: F401
from .catalog_queries import catalog_filtered_children as FLAGSHIP  # noqa: N812
from .registering import oracle_sql, queries

__all__ = ["FLAGSHIP", "oracle_sql", "queries"]
