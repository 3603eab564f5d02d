"""Partition layout, indexes, upsert and retention of events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.times import grid_cell, offset_in_partition
from seriesmill.functions.values import hash_bucket, shape_kind
from seriesmill.operators.fold import Chain, fold
from seriesmill.operators.kernels import GridChange, IntervalGate, PartitionRoll
from seriesmill.operators.slicing import DEFAULT_POLICY, HotKeys, Ordered, SlicePolicy
from seriesmill.schemas import DAY, HOUR, SECOND


def roll_partitions(
    events: DataFrame,
    keys: Sequence[str] = ("series",),
    max_rows: int = 64_000,
    span_ns: int = HOUR,
    floor_ns: int = 10 * SECOND,
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add `ts_msp`, `msp_bump`, `late` and the offset `ts_lsp`. Captured messages use 6400 rows."""
    rolled = fold(events, keys, PartitionRoll(max_rows, span_ns, floor_ns), hot=hot, policy=policy)
    return rolled.withColumn("ts_lsp", offset_in_partition())


def lay_out(
    events: DataFrame,
    roll: PartitionRoll | None = None,
    grid: GridChange | None = None,
    gate: IntervalGate | None = None,
    keys: Sequence[str] = ("series",),
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Partition, grid flag and, with a gate, admission of every event in one pass and one shuffle.

    Dropped rows stay in the result with `admitted` false and no layout.
    """
    steps = [roll or PartitionRoll(), grid or GridChange()]
    chain = Chain(gate, *steps, keep="admitted") if gate else Chain(*steps)
    return fold(events, keys, chain, hot=hot, policy=policy).withColumn("ts_lsp", offset_in_partition())


def mark_grid_changes(
    events: DataFrame,
    keys: Sequence[str] = ("series",),
    unit: int = 10 * SECOND,
    spacing: int = 30,
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add `ts_msp_grid`: the grid cell where it differs from the previous one of the series, else null."""
    cells = events.withColumn("_cell", grid_cell("ts_ns", unit, spacing))
    changed = Ordered(cells, keys, hot=hot, policy=policy).lag("_before", "_cell").done()
    differs = F.col("_cell") != F.coalesce("_before", F.lit(0))
    return changed.withColumn("ts_msp_grid", F.when(differs, F.col("_cell"))).drop("_cell", "_before")


def partition_index(laid_out: DataFrame) -> DataFrame:
    """Partitions of every series, those of late rows included."""
    return laid_out.filter("ts_msp is not null").select("series", "ts_msp").distinct()


def grid_index(laid_out: DataFrame) -> DataFrame:
    """Which series are active in a grid cell."""
    return (
        laid_out.filter("ts_msp_grid is not null")
        .select(
            hash_bucket("series").cast("int").alias("part"),
            "ts_msp_grid",
            shape_kind().alias("shape_kind"),
            "scalar_type",
            "series",
        )
        .distinct()
    )


def last_write_wins(df: DataFrame, keys: Sequence[str], written: Sequence[str] = ("written_at", "seq")) -> DataFrame:
    """One row per primary key, the one written last.

    `max_by` combines before the shuffle, so many copies of one key cost one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*written)).alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


# Default retention per item class, in nanoseconds.
RETENTION = {"index": 3 * DAY, "scalar": DAY, "array": 12 * HOUR, "binned": 40 * DAY}


def unexpired(
    df: DataFrame,
    now_ns: Column | int,
    item_class: str | Column = "scalar",
    retention: Mapping[str, int] = RETENTION,
    written: str = "written_at",
) -> DataFrame:
    """Rows whose retention has not passed at `now_ns`; `item_class` is a class or a column of classes."""
    now = F.lit(now_ns) if isinstance(now_ns, int) else now_ns
    if isinstance(item_class, str):
        # a plain bound on the column, so that it reaches the file scan
        return df.filter(F.col(written) > now - F.lit(retention[item_class]))
    ttl = F.coalesce(*[F.when(item_class == name, F.lit(ns)) for name, ns in retention.items()])
    return df.filter(F.col(written) + ttl > now)
