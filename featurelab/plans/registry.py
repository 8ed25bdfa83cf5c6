"""Query registry: every registered query is a Spark callable ``(spark,
sf_dir) -> DataFrame`` paired, where SQL can express it, with an oracle SQL
string that DuckDB runs over the same parquet tables.

Conventions shared by both sides: doubles rounded to 4 dp, counts bigint,
identical column names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    ids: tuple[str, ...]
    sql: str | None = None
    note: str = ""
    tags: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None, note: str = ""):
    """Decorator registering a query under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, tuple(ids.split()), sql, note)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module (they register on import)."""
    from featurelab.plans import (  # noqa: F401
        core, encoding, evaluation, store, text, models, learning, io_stream)
    return REGISTRY
