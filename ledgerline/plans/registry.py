"""Registry of runnable query plans and their DuckDB oracle SQL.

Each registered key pairs a ``(spark, sf_dir) -> DataFrame`` function with
the SQL that computes the same answer on the same Parquet tables.  Column
names match between the two; floating results are either exact (integer or
decimal sums divided once) or rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class QuerySpec:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None, note: str = ""):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name!r}")
        REGISTRY[name] = QuerySpec(name, fn, sql, note)
        return fn
    return deco


def _load_all() -> None:
    # Importing the plan modules fills REGISTRY.
    from . import analytical, stages  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v.run for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v.sql for k, v in REGISTRY.items() if v.sql}
