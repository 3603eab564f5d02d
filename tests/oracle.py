"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def kind(t: str) -> str:
    t = t.lower()
    if t in ("string", "varchar"):
        return "text"
    return {"int": "integer", "long": "bigint", "short": "smallint", "byte": "tinyint", "float": "float"}.get(t, t)


def spark_rows(df):
    names = sorted(df.columns)
    types = [kind(df.schema[n].dataType.simpleString()) for n in names]
    table = df.select(*[f"`{n}`" for n in names]).toArrow()
    cols = [c.to_pylist() for c in table.columns]
    return names, types, sorted((tuple(map(_plain, r)) for r in zip(*cols)), key=repr)


def duck_rows(con, sql: str):
    rel = con.sql(sql)
    names = sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    rows = rel.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    return names, [kind(types[n]) for n in names], sorted((tuple(map(_plain, r)) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    names, types, rows = spark_rows(df)
    onames, otypes, orows = duck_rows(con, sql)
    if names != onames:
        return f"columns {names} != {onames}"
    if types != otypes:
        return f"types {dict(zip(names, types))} != {dict(zip(onames, otypes))}"
    if len(rows) != len(orows):
        return f"row counts {len(rows)} != {len(orows)}"
    bad = [(a, b) for a, b in zip(rows, orows) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, first {bad[0]}"
    return None if rows else "both empty"
