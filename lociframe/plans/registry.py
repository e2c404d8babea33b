"""All registered queries of the interval, pair, matrix and table operators, and their SQL."""

from __future__ import annotations

from lociframe.plans import cell_queries, domain_queries, flow_queries, read_queries, region_queries, table_queries

PARTS = (region_queries, table_queries, cell_queries, domain_queries, flow_queries, read_queries)
QUERIES: dict = {k: v for part in PARTS for k, v in part.QUERIES.items()}
ORACLE_SQL: dict = {k: v for part in PARTS for k, v in part.ORACLE_SQL.items()}
