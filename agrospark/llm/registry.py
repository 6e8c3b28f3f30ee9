"""Registry of the training-data queries: ``register(name, sql)`` over ``fn(spark, sf_dir)``."""

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


def load_all() -> tuple[dict[str, Callable], dict[str, str]]:
    from agrospark.llm import queries  # noqa: F401
    return QUERIES, ORACLE
