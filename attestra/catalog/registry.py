"""Registry of named queries and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def values(mapping: dict, *cols: str) -> str:
    """DuckDB VALUES list of a mapping, for oracle text built from the same parameters."""
    rows = ", ".join("(" + ", ".join(repr(x) for x in kv) + ")" for kv in mapping.items())
    return f"(VALUES {rows}) AS t({', '.join(cols)})"


def sql_list(items) -> str:
    return "[" + ", ".join("'" + str(i).replace("'", "''") + "'" for i in items) + "]"
