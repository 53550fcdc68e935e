"""Named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that gives the same rows on the same tables."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _nudge(places: int) -> float:
    """Added before rounding: means of two-decimal values often lie exactly between two roundings."""
    return 3.1e-3 * 10.0**-places


def rounded(df: DataFrame, keep: list[str], places: int = 4) -> DataFrame:
    """`keep` as they are, every DOUBLE rounded, so that summation order does not show."""
    cells = [
        f"round(`{c}` + {_nudge(places)!r}D, {places}) AS `{c}`" if t == "double" and c not in keep else f"`{c}`"
        for c, t in df.dtypes
    ]
    return df.selectExpr(*cells)


def r(sql: str, name: str, places: int = 4) -> str:
    """The same rounding in the oracle; + 0.0 turns a negative zero into zero."""
    return f"round(({sql}) + {_nudge(places)!r}::DOUBLE, {places}) + 0.0 AS {name}"
