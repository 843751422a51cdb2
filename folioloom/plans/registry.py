"""All core queries by name, with the SQL that states the same result."""

from __future__ import annotations

from folioloom.plans import action_queries, catalog_queries, data_queries, flow_queries, pipeline_queries, text_queries  # noqa: F401  (all register with catalog_queries)

QUERIES: dict = {**catalog_queries.QUERIES, **data_queries.QUERIES}
SQL: dict[str, str] = {**catalog_queries.SQL}
FLAGSHIP = "agg_word_totals"
