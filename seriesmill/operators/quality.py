"""Filters and data-quality classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.slicing import DEFAULT_POLICY, HotKeys, Ordered, SlicePolicy
from seriesmill.schemas import SECOND

# Limits of the clock-skew classes in seconds, and the valid pulse range.
SKEW_LIMITS = (300, 120, 20, 3)
PULSE_RANGE = (14_781_000_000, 49_000_000_000)


def include_channels(
    channels: DataFrame, whitelist: str | None = None, blacklist: str | None = None, column: str = "channel"
) -> DataFrame:
    """Keep what the whitelist matches; of the rest, drop what the blacklist matches."""
    name = F.col(column)
    if blacklist is None:
        return channels
    keep = ~name.rlike(blacklist)
    if whitelist is not None:
        keep = name.rlike(whitelist) | keep
    return channels.filter(keep)


def find_channels(channels: DataFrame, pattern: str, column: str = "channel") -> DataFrame:
    """Channels that match a pattern; one that the engine's own compiler refuses finds nothing."""
    try:
        channels.sparkSession.sql("SELECT '' RLIKE :p", {"p": pattern}).collect()
    except PySparkException:
        return channels.filter(F.lit(False))
    return channels.filter(F.col(column).rlike(pattern))


def skew_class(ts: Column | str, arrival: Column | str) -> Column:
    """Class of the clock difference in whole seconds exceeded: 300, 120, 20, 3 or 0."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    arrival = F.col(arrival) if isinstance(arrival, str) else arrival
    apart = F.abs(ts - arrival)
    classes = F.lit(None).cast("int")
    for limit in reversed(SKEW_LIMITS):
        classes = F.when(apart > limit * SECOND, limit).otherwise(classes)
    return F.coalesce(classes, F.lit(0))


def skew_counts(events: DataFrame, ts: str = "ts_ns", arrival: str = "arrival_ns") -> DataFrame:
    return events.groupBy(skew_class(ts, arrival).alias("skew_over_s")).agg(F.count(F.lit(1)).alias("n"))


def pulse_out_of_range(pulse: Column | str = "pulse") -> Column:
    pulse = F.col(pulse) if isinstance(pulse, str) else pulse
    return (pulse != 0) & ~pulse.between(*PULSE_RANGE)


def pulse_matches_time(pulse: Column | str = "pulse", ts: Column | str = "ts_ns") -> Column:
    """Pulse and time must agree in their last six digits."""
    pulse = F.col(pulse) if isinstance(pulse, str) else pulse
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.pmod(pulse, F.lit(1_000_000)) == F.pmod(ts, F.lit(1_000_000))


def frame_count_ok(frames: str = "frames", channels: str = "channels") -> Column:
    """Two header frames and two frames per channel."""
    return F.size(frames) - 2 * F.size(channels) == 2


def header_hash_ok(frames: str = "frames", declared: str = "hash") -> Column:
    return F.md5(F.element_at(frames, 2)) == F.lower(F.col(declared))


def within_limit(pos: str = "pos", most: int | None = None) -> Column:
    """Whether a channel, by its position in the message, is among the first `most`; all are without a limit."""
    return F.lit(True) if most is None else F.col(pos) < most


def pick_channels(values: DataFrame, names: Sequence[str], column: str = "channel") -> DataFrame:
    return values.filter(F.col(column).isin(*names))


def header_changes(
    messages: DataFrame,
    keys: Sequence[str] = ("source",),
    digest: str = "header_md5",
    order: Sequence[str] = ("ts_ns", "seq"),
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add `header_changed`: the digest differs from the one of the previous message of the source."""
    rows = Ordered(messages, keys, order=order, hot=hot, policy=policy).lag("_before", digest).done()
    changed = F.coalesce(F.col("_before") != F.col(digest), F.lit(False))
    return rows.withColumn("header_changed", changed).drop("_before")
