"""Time-weighted bins and their patches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.times import bucket
from seriesmill.operators.slicing import DEFAULT_POLICY, HotKeys, Ordered, SlicePolicy
from seriesmill.schemas import MINUTE

# Scalar types that are binned.
BINNED_TYPES = ("I8", "I16", "I32", "F32", "F64")


def binnable(events: DataFrame) -> DataFrame:
    """Scalar rows of a type the bins are made of; other types and waves are skipped."""
    return events.filter(F.col("scalar_type").isin(*BINNED_TYPES) & (F.size("shape_dims") == 0))


def touch_bins(rows: DataFrame, bin_ns: int, start: str = "ts_ns") -> DataFrame:
    """Rows whose value holds from `start` to `until`, once for each end and once for all bins between them.

    Other rows may share the bins of the ends, none can those between: first_bin, last_bin, and `overlap`
    with them; `first` and `last` are the bins of the ends.
    """
    rows = rows.withColumn("first", bucket(start, bin_ns))
    rows = rows.withColumn("last", F.greatest(F.col("first"), bucket(F.col("until") - 1, bin_ns)))
    first, last = F.col("first"), F.col("last")
    part = lambda a, b: F.struct(a.alias("first_bin"), b.alias("last_bin"))
    parts = F.filter(
        F.array(part(first, first), part(first + 1, last - 1), part(last, last)),
        lambda x, i: (i == 0) | ((i == 1) & (x["first_bin"] <= x["last_bin"])) | ((i == 2) & (last > first)),
    )
    touched = rows.select("*", F.inline(parts))
    begin = F.greatest(F.col(start), F.col("first_bin") * bin_ns)
    overlap = F.greatest(F.least(F.col("until"), (F.col("last_bin") + 1) * bin_ns) - begin, F.lit(0))
    return touched.withColumn("overlap", overlap.cast("double"))


def bin_runs(
    events: DataFrame,
    bin_ns: int = MINUTE,
    keys: Sequence[str] = ("series",),
    value: str = "value",
    *,
    max_carry_ns: int | None,
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Bins of every series, run-length coded: first_bin, last_bin, count, min, max, avg.

    A value holds until the next event of its series, at most for `max_carry_ns`; None holds it
    however long the gap. The bins that lie wholly within a gap have that one value, so they are one
    row, whatever their number; bins with an event or an end in them are rows of their own. Bins reach
    from the first event to the last; one without events has count 0 while a value is carried.
    """
    keys = tuple(keys)
    rows = (
        Ordered(events.select(*keys, "ts_ns", "seq", F.col(value).alias("value")), keys, hot=hot, policy=policy)
        .lead("next_ts", "ts_ns")
        .done()
    )
    until = F.coalesce("next_ts", "ts_ns")
    if max_carry_ns is not None:
        until = F.least(until, F.col("ts_ns") + max_carry_ns)
    touched = touch_bins(rows.withColumn("until", until), bin_ns)
    binned = touched.groupBy(*keys, "first_bin", "last_bin").agg(
        F.count_if(F.col("first_bin") == F.col("first")).alias("count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.sum(F.col("value") * F.col("overlap")).alias("_weighted"),
        F.sum("overlap").alias("_weight"),
        # a bin without weight holds the last event of its series; no struct is compared, so the
        # aggregation can hash
        F.max(F.when(F.col("next_ts").isNull(), F.col("value"))).alias("_last"),
    )
    # A run has one value; dividing its weight out again would only round it.
    avg = F.when(F.col("first_bin") < F.col("last_bin"), F.col("min")).when(F.col("_weight") > 0, F.col("_weighted") / F.col("_weight")).otherwise(F.col("_last"))
    return binned.select(*keys, "first_bin", "last_bin", "count", "min", "max", avg.alias("avg"))


# Bins that a gap is taken apart into at a time.
RUN_BLOCK = 4096


def expand_runs(runs: DataFrame, bin_ns: int, from_bin: int | None = None, to_bin: int | None = None) -> DataFrame:
    """Runs of bins as single bins (`bin`, `bin_ts_ns`), of the range asked; no array is longer than `RUN_BLOCK`, or the number of such blocks of a run."""
    lo = F.col("first_bin") if from_bin is None else F.greatest("first_bin", F.lit(from_bin).cast("long"))
    hi = F.col("last_bin") if to_bin is None else F.least("last_bin", F.lit(to_bin).cast("long"))
    inside = runs.withColumns({"_lo": lo, "_hi": hi}).filter("_lo <= _hi")
    inside = inside.withColumn("_b", F.explode(F.sequence("_lo", "_hi", F.lit(RUN_BLOCK).cast("long"))))
    single = inside.withColumn("bin", F.explode(F.sequence("_b", F.least(F.col("_b") + RUN_BLOCK - 1, F.col("_hi")))))
    own = [c for c in runs.columns if c not in ("first_bin", "last_bin", "count", "min", "max", "avg")]
    return single.select(*own, "bin", (F.col("bin") * bin_ns).alias("bin_ts_ns"), "count", "min", "max", "avg")


def time_weighted_bins(
    events: DataFrame,
    bin_ns: int = MINUTE,
    keys: Sequence[str] = ("series",),
    value: str = "value",
    *,
    max_carry_ns: int | None,
    single_precision: bool = False,
    from_bin: int | None = None,
    to_bin: int | None = None,
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Count, minimum, maximum and time-weighted mean of every series and bin, of the range asked.

    See `bin_runs`, which has a long gap in one row; here it makes one row for every bin of it.
    """
    runs = bin_runs(events, bin_ns, keys, value, max_carry_ns=max_carry_ns, hot=hot, policy=policy)
    binned = expand_runs(runs, bin_ns, from_bin, to_bin)
    kind = "float" if single_precision else "double"
    return binned.withColumns({c: F.col(c).cast(kind) for c in ("min", "max", "avg")})


def bin_patches(
    bins: DataFrame, bin_ns: int = MINUTE, bin_count: int = 60, keys: Sequence[str] = ("series",)
) -> DataFrame:
    """Aligned patches of `bin_count` bins as parallel arrays; incomplete patches are left out.

    A group never holds more than `bin_count` rows, so the list stays small at any scale.
    """
    off = bucket("bin", bin_count)
    entry = F.struct("bin", "count", "min", "max", "avg")
    patches = (
        bins.groupBy(*keys, off.alias("off"))
        .agg(F.array_sort(F.collect_list(entry)).alias("_bins"))
        .filter(F.size("_bins") == bin_count)
    )
    return patches.select(
        *keys,
        F.lit(bin_ns // 1_000_000_000).alias("bin_len_sec"),
        F.lit(bin_count).alias("bin_count"),
        bucket("off", 1000).alias("off_msp"),
        F.pmod("off", F.lit(1000)).alias("off_lsp"),
        F.col("_bins.count").alias("counts"),
        F.col("_bins.min").alias("mins"),
        F.col("_bins.max").alias("maxs"),
        F.col("_bins.avg").alias("avgs"),
    )
