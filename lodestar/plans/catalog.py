"""Registry of named queries: a Spark builder and, where SQL can express it,
the DuckDB oracle SQL with the same column names."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from lodestar.plans import (queries_core, queries_dedup, queries_html, queries_quality,  # noqa: F401
                                queries_extract, queries_jobs, queries_single, queries_store,
                                queries_text)
    return REGISTRY
