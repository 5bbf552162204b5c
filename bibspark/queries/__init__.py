"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each module in this package registers the queries of one operator family;
the Spark builder takes ``(spark, sf_dir)`` and returns a DataFrame, the
oracle is plain SQL over the driver tables (fixture CTEs added here).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import with_fixtures

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}

MODULES = (
    "sources", "expressions", "joins", "rules", "graph", "conversion", "streams", "sinks",
)


def query(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return REGISTRY


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: with_fixtures(v[1]) for k, v in load_all().items() if v[1]}
