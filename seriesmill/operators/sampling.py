"""Sampling, load copies and batching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.slicing import DEFAULT_POLICY, HotKeys, Ordered, SlicePolicy

SOURCE = ("source",)


def sample_hashed(items: DataFrame, per_mille: int, keys: Sequence[str] = SOURCE, order: Sequence[str] = ("ts_ns", "seq")) -> DataFrame:
    """Keep about `per_mille` of a thousand rows, by a hash of the row: the same ones in a stream as in a table."""
    return items.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(1000)) < per_mille)


def sample_fraction(
    items: DataFrame,
    per_mille: int,
    keys: Sequence[str] = SOURCE,
    order: Sequence[str] = ("ts_ns", "seq"),
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Keep the first `per_mille` of every thousand rows of a source. Streams have no position: see `sample_hashed`."""
    if items.isStreaming:
        raise ValueError("a stream has no positions; use sample_hashed")
    rows = Ordered(items, keys, order, hot, policy).position("_i").done()
    return rows.filter(F.pmod("_i", F.lit(1000)) < per_mille).drop("_i")


def with_load_copies(
    events: DataFrame,
    copies: Sequence[tuple[int, int]],
    keys: Sequence[str] = SOURCE,
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """For each `(m, l)` with position mod m = l, one more row shortly before the original.

    Copy number i stands `1 + i` ns earlier; `copy` is null on originals.
    """
    rows = Ordered(events, keys, hot=hot, policy=policy).position("_c").done()
    picks = [F.when(F.pmod("_c", F.lit(m)) == at, F.lit(i)) for i, (m, at) in enumerate(copies)]
    chosen = F.filter(F.array(*picks, F.lit(-1)), lambda i: i.isNotNull())
    rows = rows.withColumn("copy", F.explode(chosen))
    shift = F.when(F.col("copy") >= 0, F.col("copy") + 1).otherwise(0)
    return rows.withColumn("ts_ns", F.col("ts_ns") - shift).withColumn("copy", F.when(F.col("copy") >= 0, F.col("copy"))).drop("_c")


def batches(
    items: DataFrame,
    size: int,
    idle_ns: int,
    keys: Sequence[str] = SOURCE,
    order: Sequence[str] = ("ts_ns", "seq"),
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add `session` and `batch`: a batch ends after `size` rows or an idle gap."""
    ts = F.col(order[0])
    rows = Ordered(items, keys, order, hot, policy).lag("_before", order[0])
    rows.position("_i").with_column("_new", F.col("_before").isNull() | (ts - F.col("_before") > idle_ns))
    rows.running_sum("session", F.col("_new").cast("long"))
    rows.running_max("_start", F.when(F.col("_new"), F.col("_i")))
    batch = F.floor((F.col("_i") - F.col("_start")) / size).cast("long")
    return rows.done().withColumn("batch", batch).drop("_before", "_i", "_new", "_start")


def batch_sizes(batched: DataFrame, keys: Sequence[str] = SOURCE, ts: str = "ts_ns") -> DataFrame:
    """One row per batch. A batch holds at most `size` rows, so no group is large."""
    return batched.groupBy(*keys, "session", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
