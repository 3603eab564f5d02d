"""Moving statistics, gates and limiters as table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.times import minute_floor
from seriesmill.operators.fold import fold
from seriesmill.operators.kernels import IntervalEma, IntervalGate, RateLimiter, Throttle, ValueEma
from seriesmill.schemas import SECOND

SERIES = ("series",)


def value_ema(events: DataFrame, keys: Sequence[str] = SERIES, k: float = 0.05, value: str = "value", **how):
    """Moving average `ema`, variance `emv` and number of updates of a value column."""
    return fold(events, keys, ValueEma(k, value), **how)


def interval_ema(events: DataFrame, keys: Sequence[str] = SERIES, k: float = 0.05, **how) -> DataFrame:
    """Moving average and variance of the seconds between the rows of a key."""
    return fold(events, keys, IntervalEma(k), **how)


def ema_preview(at_ns: Column, k: float = 0.05, ema: str = "ema", last: str = "ts_ns") -> Column:
    """What the interval average would become with a row at `at_ns`; null before the first row."""
    dt = (at_ns - F.col(last)).cast("double") / 1e9
    before = F.coalesce(F.col(ema), F.lit(0.0))
    return before + F.lit(k) * (dt - before)


def rate_alarms(
    messages: DataFrame, keys: Sequence[str] = ("source",), k: float = 0.01, updates: int = 100, below_s: float = 0.005, **how
) -> DataFrame:
    """Messages at which the source sends too fast: enough updates and a short mean interval."""
    fast = (F.col("ema_count") > updates) & (F.col("ema") < below_s)
    return interval_ema(messages, keys, k, **how).filter(fast)


def gate(
    events: DataFrame,
    keys: Sequence[str] = SERIES,
    ivl_ns: int = 6_000_000,
    k: float = 0.05,
    report_ns: int = 10 * SECOND,
    ts: str = "ts_ns",
    seq: str = "seq",
    **how,
) -> DataFrame:
    """Add `admitted` and the interval reports of the dropped rows."""
    return fold(events, keys, IntervalGate(ivl_ns, k, report_ns, ts), order=(ts, seq), **how)


def interval_reports(gated: DataFrame, keys: Sequence[str] = SERIES, ts: str = "ts_ns") -> DataFrame:
    """The throttled interval reports of a gated table."""
    return gated.filter("report").select(
        *keys, ts, F.col("report_ema").alias("ema"), F.col("report_emd").alias("emd")
    )


def dropped_counts(gated: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    return gated.groupBy(*keys).agg(
        F.count_if("admitted").alias("admitted"), F.count_if(~F.col("admitted")).alias("dropped")
    )


def limit_rate(items: DataFrame, keys: Sequence[str] = ("source",), rate: float = 5000.0, **how) -> DataFrame:
    """Add `forwarded`; rows that are not `droppable` always pass."""
    options = {n: how.pop(n) for n in ("k", "cap_ns", "initial_ema", "ts", "droppable") if n in how}
    return fold(items, keys, RateLimiter(rate, **options), **how)


def throttle(events: DataFrame, keys: Sequence[str] = SERIES, every_ns: int = 10 * SECOND, **how) -> DataFrame:
    """Add `emitted`: at most one row per key and `every_ns`."""
    return fold(events, keys, Throttle(every_ns), **how)


def channel_pings(events: DataFrame, k: float = 0.05, **how) -> DataFrame:
    """Per series and minute, the interval average at its last event."""
    ema = interval_ema(events, SERIES, k, **how)
    latest = F.max_by("ema", F.struct("ts_ns", "seq"))
    return ema.groupBy(minute_floor().alias("minute"), "series").agg(
        latest.alias("ivl"), F.lit(0.0).alias("interest"), F.lit(0).alias("evsize")
    )
