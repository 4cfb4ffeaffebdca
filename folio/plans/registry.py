"""Registry of named queries: a Spark builder and (where SQL can say it) an oracle.

A query reads the driver tables under ``sf_dir`` and returns a DataFrame with plain
scalar columns, so results can be compared value by value with the SQL oracle.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, operators: tuple[str, ...] = ()):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco
