"""Query registry: name → (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None, ops: str = ""):
    """Register a query builder with its oracle SQL (None: rows-only check)."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle.strip() if oracle else None, tuple(ops.split()))
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # importing the modules registers their queries
    from kestrel.plans import q_sources, q_relational, q_stats, q_sampling, q_models, q_model_checks, q_trees, q_ingest  # noqa: F401
    return dict(REGISTRY)
