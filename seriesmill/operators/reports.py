"""Activity, state and counter reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.times import bucket, iso_millis
from seriesmill.functions.values import interest_score, shape_kind
from seriesmill.operators.slicing import DEFAULT_POLICY, HotKeys, Ordered, SlicePolicy
from seriesmill.schemas import MINUTE, SECOND


def activity(events: DataFrame, window_ns: int = MINUTE) -> DataFrame:
    """Per window and series: number of events and the last partition, offset and pulse."""
    latest = F.struct("ts_ns", "seq")
    return events.groupBy(bucket("ts_ns", window_ns).alias("window"), "series", shape_kind(most=2).alias("shape_kind")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("ts_msp", latest).alias("last_msp"),
        F.max_by("ts_lsp", latest).alias("last_lsp"),
        F.max_by("pulse", latest).alias("last_pulse"),
    )


def most_active(report: DataFrame, n: int = 6, window: str = "window") -> DataFrame:
    """The `n` busiest scalar and wave series of every window; Spark cuts each task's share to `n` first."""
    w = Window.partitionBy(window, "shape_kind").orderBy(F.col("n").desc(), F.col("series"))
    return report.filter("shape_kind < 2").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


# Lifecycle states of a channel, with their names in the two groupings of the report.
STATE_GROUPS = {
    "init": ("unknown_address", None),
    "wait_status_series": ("unknown_address", None),
    "unknown_address": ("unknown_address", "unknown_address"),
    "search_pending": ("search_pending", "search_pending"),
    "unassigned": ("with_address", "unassigned"),
    "assigned": ("with_address", "assigned"),
    "no_address": ("no_address", "no_address"),
    "to_remove": ("unknown_address", None),
}


def _named(state: str, names: Sequence[str]) -> Column:
    return F.count_if(F.col(state).isin(*names))


def state_counts(channels: DataFrame, state: str = "state") -> DataFrame:
    """One row with the number of channels per coarse lifecycle state."""
    groups = sorted({coarse for coarse, _ in STATE_GROUPS.values()})
    return channels.agg(*[_named(state, [s for s, g in STATE_GROUPS.items() if g[0] == name]).alias(name) for name in groups])


def detailed_state_counts(channels: DataFrame, state: str = "state", sent: str = "did_send") -> DataFrame:
    """One row with the number of channels per detailed state, searches already sent apart."""
    groups = sorted({fine for _, fine in STATE_GROUPS.values() if fine})
    counts = [_named(state, [s for s, g in STATE_GROUPS.items() if g[1] == name]).alias(name) for name in groups]
    search_sent = F.count_if((F.col(state) == "search_pending") & F.col(sent)).alias("search_sent")
    return channels.agg(*counts, search_sent)


def liveness(events: DataFrame, now_ns: Column | int, within_ns: int = 10 * SECOND) -> DataFrame:
    """One row: channels, those with an event less than `within_ns` ago, and the others."""
    now = F.lit(now_ns) if isinstance(now_ns, int) else now_ns
    last = events.groupBy("series").agg(F.max("ts_ns").alias("last_ts"))
    alive = now - F.col("last_ts") < within_ns
    return last.agg(
        F.count(F.lit(1)).alias("all"), F.count_if(alive).alias("alive"), F.count_if(~alive).alias("not_alive")
    )


# What a channel's state says about its connection.
CONNECTED_INFO = {
    "Init": "Disconnected",
    "Creating": "Connecting",
    "FetchingSeriesId": "Connecting",
    "Created": "Connected",
    "Error": "Error",
    "Ended": "Ended",
}


def channel_states(latest: DataFrame) -> DataFrame:
    """State rows: `latest` holds, per channel, the state and what is known of it when created.

    Columns: channel, addr, state, series, scalar_type, shape_dims, ts_created, ts_ns, ema, ema_count.
    """
    info = F.coalesce(*[F.when(F.col("state") == s, F.lit(i)) for s, i in CONNECTED_INFO.items()])
    created = F.col("state") == "Created"
    ema = F.when(created & (F.col("ema_count") > 0), F.col("ema"))
    when = lambda c: F.when(created, F.col(c))
    return latest.select(
        "channel",
        "addr",
        when("series").alias("series"),
        info.alias("connected_info"),
        when("scalar_type").alias("scalar_type"),
        when("shape_dims").alias("shape_dims"),
        F.when(created, iso_millis("ts_created")).alias("ts_created"),
        F.when(created, iso_millis("ts_ns")).alias("ts_event_last"),
        ema.alias("recv_ivl_ema"),
        interest_score(ema).alias("interest_score"),
    )


def list_states(states: DataFrame, limit: int = 40, order: Sequence[str] = ("channel",)) -> DataFrame:
    return states.orderBy(*order).limit(limit)


def sum_counters(counters: DataFrame) -> DataFrame:
    """Sum of every counter over its sources, with the number of sources."""
    return counters.groupBy("name").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("sources"))


def counter_lines(totals: DataFrame, app: str, prefix: str | None = None) -> DataFrame:
    """Text lines `<app>[_prefix]_<name> <value>`."""
    head = f"{app}_{prefix}" if prefix else app
    line = F.concat(F.lit(f"{head}_"), F.col("name"), F.lit(" "), F.col("value").cast("string"))
    return totals.select(line.alias("value"))


def counter_differences(
    counters: DataFrame, hot: HotKeys | None = None, policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Difference and elapsed time between successive snapshots of every counter."""
    keys = ("source", "name")
    rows = Ordered(counters, keys, order=("ts_ns",), hot=hot, policy=policy).lag("_before", F.struct("value", "ts_ns")).done()
    rows = rows.filter("_before is not null")
    return rows.select(
        *keys,
        "ts_ns",
        (F.col("value") - F.col("_before.value")).alias("diff"),
        (F.col("ts_ns") - F.col("_before.ts_ns")).alias("dt_ns"),
    )


def distinct_keys(df: DataFrame, column: str = "pulse_a") -> DataFrame:
    return df.select(column).distinct()


def greatest_key(df: DataFrame, column: str = "pulse_a") -> DataFrame:
    return df.agg(F.max(column).alias(column))


def payload_sizes(values: DataFrame) -> DataFrame:
    """Payload bytes of every message, from its value frames."""
    return values.groupBy("source", "msg_id").agg(
        F.min("recv_ts_ns").alias("recv_ts_ns"), F.sum(F.octet_length("payload")).alias("payload_bytes")
    )


def payload_rates(messages: DataFrame, window_ns: int = 2 * SECOND) -> DataFrame:
    """Messages and bytes per interval, also as kilobytes per second."""
    seconds = window_ns / SECOND
    return messages.groupBy("source", bucket("recv_ts_ns", window_ns).alias("window")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum("payload_bytes").alias("payload_bytes"),
        (F.sum("payload_bytes") / 1000.0 / seconds).alias("kb_per_s"),
    )
