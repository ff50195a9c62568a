"""Named queries, each with the DuckDB text it must agree with (where SQL can say it)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskgraph.fixtures import DUCK_TABLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Common table expressions in dependency order; sections add their own.
PARTS: dict[str, str] = dict(DUCK_TABLES)


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def with_parts(body: str, *names: str) -> str:
    """`body` behind the named tables and everything they need, in definition order."""
    needed: set[str] = set()

    def need(name: str) -> None:
        if name in needed:
            return
        needed.add(name)
        for other in PARTS:
            if other != name and _mentions(PARTS[name], other):
                need(other)

    for name in names or [n for n in PARTS if _mentions(body, n)]:
        need(name)
    tables = ",\n".join(f"{n} AS (\n{PARTS[n]}\n)" for n in PARTS if n in needed)
    return f"WITH RECURSIVE {tables}\n{body}" if tables else body


def _mentions(sql: str, name: str) -> bool:
    return re.search(rf"\b{name.split('(')[0]}\b", sql) is not None


def oracle_texts() -> dict[str, str]:
    """Every DuckDB text behind its named tables, which may have been defined after the query."""
    return {key: with_parts(sql) for key, sql in ORACLES.items()}


def query(key: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def r6(column: str | Column, places: int = 6) -> Column:
    """Rounded for comparison: summation order differs between engines."""
    c = F.col(column) if isinstance(column, str) else column
    out = F.round(c, places)
    return out.alias(column) if isinstance(column, str) else out
