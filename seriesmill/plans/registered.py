"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def rounded(c: str | Column, digits: int, name: str | None = None) -> Column:
    """A double rounded for comparison; `+ 0` turns a negative zero positive."""
    column = F.col(c) if isinstance(c, str) else c
    return (F.round(column.cast("double"), digits) + F.lit(0.0)).alias(name or c)


def user_events(extra: str = "") -> str:
    return f"""ev AS (SELECT user_id AS series, epoch_ns(ts) AS ts_ns, event_id AS seq, value{extra} FROM events)"""


def numbered(extra: str = "") -> str:
    """Events with their position in the series, the input of recursive folds."""
    return f"""{user_events(extra)},
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts_ns, seq) AS i FROM ev)"""
