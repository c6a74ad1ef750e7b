"""All registered queries."""
from __future__ import annotations

from lanestride.plans import catalog_files, catalog_ingest, catalog_series, catalog_tokens

QUERIES: dict = {}
CHECK_SQL: dict[str, str] = {}
for _module in (catalog_tokens, catalog_series, catalog_ingest, catalog_files):
    QUERIES.update(_module.QUERIES)
    CHECK_SQL.update(_module.SQL)
