"""Check queries: every operator over the star-schema test tables, with a SQL twin."""

from checks import graph_queries, ingest_queries, recon_queries, source_queries, status_queries  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
