"""Name → query, name → checking SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def values(rows: Iterable[tuple], columns: str) -> str:
    """A literal table for the checking SQL."""

    def lit(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    return f"(VALUES {body}) AS t({columns})"


TOKENS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}]+'), lambda w: w <> '')"
