"""Pairs that share a centre, brought together without repeating the centre's data per pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMBERS_PER_SALT = 500
# Keys of a few numbers each that may be held by every task.
BROADCAST_KEYS = 200_000


def narrowed(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "semi") -> DataFrame:
    """Rows with (or, by `anti`, without) one of the keys; the keys are broadcast if counted to be few."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, on, how)


def meet(pairs: DataFrame, data: DataFrame) -> DataFrame:
    """For every pair `a`, `b` of nodes: the data of `a`, then that of each `b`, in one task.

    `data` has `node` and other columns. The result has a, salt, b (null for the centre's own row)
    and those columns, sorted so that a centre's row comes before its members'. A centre with many
    members is dealt out by salt and its data sent once for each.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_SALT).cast("int").alias("salts"))
    asked = pairs.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"))
    own = [c for c in data.columns if c != "node"]
    each = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    centres = salts.join(data, salts.a == data.node).select("a", each, F.lit(None).cast("long").alias("b"), *own)
    members = asked.join(data, asked.b == data.node).select("a", "salt", "b", *own)
    both = centres.unionByName(members).repartition(n, "a", "salt")
    return both.sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())


def attach(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left join of wide rows to a table by non-null keys; rows without a match are not shuffled when the keys are few."""
    keys = table.select(*on)
    if keys.count() > BROADCAST_KEYS:
        return rows.join(table, on, "left")
    matched = rows.join(F.broadcast(keys), on, "semi").join(table.hint("merge"), on)  # one plan at every size
    rest = rows.join(F.broadcast(keys), on, "anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name not in on]
    return matched.unionByName(rest.select("*", *nothing))
