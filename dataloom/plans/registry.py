"""Registry pairing each operator query with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables. ``sql`` is
the equivalent ANSI text over the same tables (views named like the files), or
``None`` when the output is random, model-valued or timing-dependent; those
rows are checked by their own tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    section: str


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, section: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None, section or fn.__module__.rsplit(".", 1)[-1])
        return fn

    return deco
