"""Named queries with their DuckDB oracle SQL.

``@query("name", sql=...)`` registers ``fn(lake) -> DataFrame``.  The oracle
body may reference the shared procurement CTEs (see ``plans.oracle_base``);
``oracle_sql()`` prefixes them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .context import Lake


@dataclass
class Registered:
    name: str
    fn: Callable[[Lake], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[Lake], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Registered(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def _load_all() -> None:
    # Importing the plan modules registers their queries.
    from .plans import (  # noqa: F401
        base_queries, gold_queries, validation_queries, volume, value, competition, opportunity,
        interactive, text_ml, bid_ml, models, xml_queries, stream_queries,
    )


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    _load_all()
    return REGISTRY[name].fn(Lake.get(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {n: (lambda spark, sf_dir, _r=r: _r.fn(Lake.get(spark, sf_dir))) for n, r in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    from .plans.oracle_base import with_base
    return {n: with_base(r.sql) for n, r in REGISTRY.items() if r.sql}
