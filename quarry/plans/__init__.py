"""Named query plans over the bundled tables.

Each plan module registers ``name -> fn(spark, sf_dir) -> DataFrame`` and, where
the result can be stated in SQL, the equivalent DuckDB query used as oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    # Importing the modules fills REGISTRY / ORACLES.
    from quarry.plans import graph, graphlearn, ml, neardup, pages, search, tables  # noqa: F401
