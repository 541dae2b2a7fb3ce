"""Registry of catalog queries: key → (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple[str, ...]


QUERIES: dict[str, Entry] = {}


def register(key: str, ids: str, sql: str | None = None):
    """Register a query under ``key`` covering the SURVEY ids in ``ids`` (space separated)."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = Entry(key, fn, sql.strip() if sql else None, tuple(ids.split()))
        return fn
    return deco


def with_ctes(*ctes: str, body: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",".join(c.strip("\n") for c in ctes) + "\n" + body
