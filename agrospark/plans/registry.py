"""Query registry: each registered query pairs a Spark builder with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` reading the whole given tables (through the
adapters) so its work grows with them. Oracle SQL runs on the same parquet tables, registered
as views by the checker. Queries without SQL are rows-only (ML, streaming state).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all():
    """Import every module that registers queries."""
    from agrospark.plans import q_clean, q_panel, q_incremental, q_features, q_rules, q_reports, q_sources, q_ml, q_stream  # noqa: F401
    return QUERIES, ORACLE
