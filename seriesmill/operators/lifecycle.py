"""Channel lifecycle with timeouts, silence detection and the status items they give."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators.fold import Kernel, fold
from seriesmill.operators.slicing import DEFAULT_POLICY, HotKeys, Ordered, SlicePolicy
from seriesmill.schemas import LONG, SECOND, STRING, struct

TRANSITION = struct(ts_ns=LONG, before=STRING, after=STRING, addr=STRING)
_ARROW_TRANSITIONS = pa.list_(
    pa.struct([("ts_ns", pa.int64()), ("before", pa.string()), ("after", pa.string()), ("addr", pa.string())])
)


@dataclass(frozen=True)
class Timeouts:
    """How long a channel stays in a state. The defaults are fixed values."""

    wait_status_series: int = 5 * SECOND
    unknown_address: int = 2 * SECOND
    search_pending: int = 30 * SECOND
    no_address: int = 20 * SECOND

    def next(self, state: str) -> tuple[int, str] | None:
        """Stay and next state of a state that ends by itself."""
        return {
            "wait_status_series": (self.wait_status_series, "init"),
            "unknown_address": (self.unknown_address, "search_pending"),
            "search_pending": (self.search_pending, "no_address"),
            "no_address": (self.no_address, "unknown_address"),
        }.get(state)


def respond(state: str, addr: str | None, event: str, event_addr: str | None) -> tuple[str, str | None]:
    """State and address after an event; an event that does not fit the state changes nothing."""
    if event == "add" and state in ("none", "init", "to_remove"):
        return "wait_status_series", None
    if event == "series" and state in ("init", "wait_status_series"):
        return "unknown_address", None
    if state == "search_pending" and event == "found" and event_addr is not None:
        return "assigned", event_addr
    if state == "search_pending" and event in ("found", "not_found"):
        return "no_address", None
    if state == "assigned" and event == "connection_done" and event_addr == addr:
        return "init", None
    if event == "remove" and state != "none":
        return "to_remove", None
    return state, addr


class Lifecycle(Kernel):
    """Walks the lifecycle log of a channel; gives the transitions up to and with each row.

    Transitions by timeout stand at the time the stay ends. A row with event `tick` only lets
    time pass.
    """

    inputs = ("ts_ns", "event", "addr")
    state = struct(state=STRING, since=LONG, addr=STRING)
    outputs = T.StructType([T.StructField("transitions", T.ArrayType(TRANSITION))])

    def __init__(self, timeouts: Timeouts = Timeouts()):
        self.timeouts = timeouts

    def fresh(self):
        return "none", 0, None

    def advance(self, state: tuple, now: int) -> tuple[tuple, list]:
        """Let time pass to `now`."""
        name, since, addr = state
        passed = []
        while (step := self.timeouts.next(name)) and since + step[0] <= now:
            since += step[0]
            passed.append((since, name, step[1], None))
            name, addr = step[1], None
        return (name, since, addr), passed

    def due(self, state: tuple) -> int | None:
        """When the state ends by itself."""
        step = self.timeouts.next(state[0])
        return state[1] + step[0] if step else None

    def run(self, state, cols):
        rows = []
        for ts, event, event_addr in zip(cols["ts_ns"].tolist(), cols["event"], cols["addr"]):
            state, passed = self.advance(state, ts)
            name, addr = respond(state[0], state[2], event, event_addr)
            if (name, addr) != (state[0], state[2]):
                passed.append((ts, state[0], name, addr))
                state = (name, ts, addr)
            rows.append([dict(zip(TRANSITION.names, p)) for p in passed])
        return state, {"transitions": pa.array(rows, type=_ARROW_TRANSITIONS)}


# The states a channel without address goes through again and again.
CYCLE = ("unknown_address", "search_pending", "no_address")


class LifecycleSteps(Lifecycle):
    """The same walk with the time-outs before a row as numbers: the state they start from, since when, how many.

    States that end by themselves form one cycle (and a way out of `wait_status_series`), so any number
    of time-outs is a division; a row takes constant memory however long the silence before it.
    """

    outputs = struct(passed_from=STRING, passed_since=LONG, passed=LONG, moved_from=STRING, moved_to=STRING, moved_addr=STRING)

    def __init__(self, timeouts: Timeouts = Timeouts()):
        super().__init__(timeouts)
        self.round = sum(timeouts.next(name)[0] for name in CYCLE)

    def skip(self, state: tuple, now: int) -> tuple[tuple, int]:
        """Let time pass to `now`: the new state, and the number of time-outs."""
        name, since, addr = state
        n = 0
        if name in CYCLE and now > since:
            rounds = (now - since) // self.round
            n, since = len(CYCLE) * rounds, since + rounds * self.round
        while (step := self.timeouts.next(name)) and since + step[0] <= now:
            name, since, n = step[1], since + step[0], n + 1
        return (name, since, None if n else addr), n

    def run(self, state, cols):
        rows = []
        for ts, event, event_addr in zip(cols["ts_ns"].tolist(), cols["event"], cols["addr"]):
            before = state
            state, n = self.skip(state, ts)
            name, addr = respond(state[0], state[2], event, event_addr)
            moved = (name, addr) != (state[0], state[2])
            rows.append((before[0], before[1], n, *((state[0], name, addr) if moved else (None, None, None))))
            if moved:
                state = (name, ts, addr)
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        return state, {n: pa.array(c, t) for n, c, t in zip(self.outputs.names, zip(*rows), types)}


def _steps(rows: DataFrame, timeouts: Timeouts) -> DataFrame:
    """Transitions from rows of a counted time-out `_k` (from 0) or of an event (`moved_to`)."""
    stays, size = [timeouts.next(name)[0] for name in CYCLE], len(CYCLE)
    states = F.array(*[F.lit(c) for c in CYCLE])
    starts = F.array(*[F.lit(sum(stays[:i])).cast("long") for i in range(size)])
    first = F.greatest(F.array_position(states, F.col("passed_from")) - 1, F.lit(0))
    at = lambda column, n: F.element_at(column, (n % size + 1).cast("int"))
    step = first + F.col("_k") + 1
    # Whole rounds, and the time from the first state of the cycle to this one, less that to the state at the start.
    spent = F.floor(step / size).cast("long") * F.lit(sum(stays)).cast("long") + at(starts, step) - at(starts, first)
    out, wait = timeouts.next("wait_status_series")[1], timeouts.wait_status_series
    event, cycling = F.col("moved_to").isNotNull(), F.col("passed_from").isin(*CYCLE)
    return rows.select(
        "channel",
        F.when(event, F.col("passed_since")).when(cycling, F.col("passed_since") + spent).otherwise(F.col("passed_since") + wait).alias("ts_ns"),
        F.when(event | ~cycling, F.col("passed_from")).otherwise(at(states, step - 1)).alias("before"),
        F.when(event, F.col("moved_to")).when(cycling, at(states, step)).otherwise(F.lit(out)).alias("after"),
        F.col("moved_addr").alias("addr"),
    )


def with_end(log: DataFrame, now_ns: int) -> DataFrame:
    """The log with one last `tick` per channel, so that stays end up to `now_ns`."""
    last = log.select("channel").distinct().select(
        "channel",
        F.lit(now_ns).alias("ts_ns"),
        F.lit(2**62).alias("seq"),
        F.lit("tick").alias("event"),
        F.lit(None).cast("string").alias("addr"),
    )
    return log.unionByName(last)


def transitions(log: DataFrame, timeouts: Timeouts = Timeouts(), **how) -> DataFrame:
    """State transitions of every channel from its lifecycle log (channel, ts_ns, seq, event, addr)."""
    rows = fold(log.select("channel", "ts_ns", "seq", "event", "addr"), ["channel"], LifecycleSteps(timeouts), **how)
    # One pass gives both kinds: the fold is not run twice.
    moved = F.struct(F.col("moved_from").alias("passed_from"), F.col("ts_ns").alias("passed_since"), F.lit(0).cast("long").alias("passed"), F.col("moved_to"), F.col("moved_addr"))
    timed = F.struct(F.col("passed_from"), F.col("passed_since"), F.col("passed"), F.lit(None).cast("string").alias("moved_to"), F.lit(None).cast("string").alias("moved_addr"))
    both = rows.select("channel", F.inline(F.array(timed, moved))).filter("passed > 0 or moved_to is not null")
    block = 4096
    steps = F.when(F.col("passed") > 0, F.expr(f"(passed - 1) div {block}")).otherwise(0)
    both = both.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), steps.cast("long"))))
    last = F.greatest(F.least(F.col("passed") - 1, (F.col("_block") + 1) * block - 1), F.col("_block") * block)
    return _steps(both.withColumn("_k", F.explode(F.sequence(F.col("_block") * block, last))), timeouts)


def current_states(changes: DataFrame) -> DataFrame:
    """State of every channel after its last transition, for the state report."""
    latest = changes.groupBy("channel").agg(F.max_by(F.struct("after", "addr"), "ts_ns").alias("_s"))
    return latest.select("channel", F.col("_s.after").alias("state"), F.col("_s.addr").alias("addr"))


# Status codes of lifecycle and connection events.
CHANNEL_EVENT_KINDS = {
    "opened": 1,
    "closed:ShutdownCommand": 2,
    "closed:ChannelRemove": 3,
    "closed:ProtocolError": 4,
    "closed:FrequencyQuota": 5,
    "closed:BandwidthQuota": 6,
    "closed:InternalError": 7,
    "closed:IocTimeout": 8,
    "closed:NoProtocol": 9,
    "closed:ProtocolDone": 10,
}
ASSIGNED_KIND = 24
CONNECTION_EVENT_KINDS = {
    "connect_error": 1,
    "connect_timeout": 2,
    "established": 3,
    "closing": 4,
    "closed_unexpected": 5,
    "connection_done": 6,
}


def _kind(column, kinds: dict[str, int]):
    table = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return F.try_element_at(table, column)


def channel_status_items(log: DataFrame, changes: DataFrame) -> DataFrame:
    """Channel status items: openings and closings of the log, and assignments to an address."""
    logged = log.select("channel", "ts_ns", _kind(F.col("event"), CHANNEL_EVENT_KINDS).alias("kind")).filter("kind is not null")
    assigned = changes.filter("after = 'assigned'").select("channel", "ts_ns", F.lit(ASSIGNED_KIND).alias("kind"))
    return logged.unionByName(assigned)


# What ends a connection, and by it every channel that is open there; what ends one channel.
CONNECTION_ENDS = {
    "shutdown": "closed:ShutdownCommand",
    "protocol_error": "closed:ProtocolError",
    "internal_error": "closed:InternalError",
    "echo_timeout": "closed:IocTimeout",
    "silence": "closed:NoProtocol",
    "protocol_done": "closed:ProtocolDone",
}
CHANNEL_ENDS = {
    "remove": "closed:ChannelRemove",
    "frequency_quota": "closed:FrequencyQuota",
    "bandwidth_quota": "closed:BandwidthQuota",
}


def derived_openings(
    channels: DataFrame, connections: DataFrame, order: Sequence[str] = ("ts_ns", "seq"), policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Openings and closings that follow from state: channel, addr, ts_ns, kind.

    `channels` has channel, addr, the order and event: `created`, or an end of `CHANNEL_ENDS`; `connections` has addr, the
    order and event, of which those of `CONNECTION_ENDS` count. A channel opens when it is created and not open,
    and closes at its own end or at that of its connection, whichever comes first, for that reason. An end that
    finds no open channel gives nothing. Places in the order have to differ among the rows of an address.
    """
    place = F.struct(*order)
    reasons = F.create_map(*[F.lit(x) for pair in (CONNECTION_ENDS | CHANNEL_ENDS).items() for x in pair])
    reason = F.try_element_at(reasons, F.col("event"))
    all_ends = connections.filter(F.col("event").isin(*CONNECTION_ENDS)).select(F.lit(None).cast("string").alias("channel"), "addr", *order, "event")
    both = channels.select(F.col("channel").cast("string"), "addr", *order, "event").unionByName(all_ends).withColumn("_reason", reason)
    of_connection = F.col("channel").isNull()
    ended = F.when(of_connection, F.struct(*order, "_reason"))
    by_addr = Ordered(both, ["addr"], order, policy=policy).running_max("_before", F.when(of_connection, place)).next_match("_after", ended).done()
    own = by_addr.filter(~of_connection).withColumn("_is_end", F.col("_reason").isNotNull())
    steps = Ordered(own, ["channel", "addr"], order, policy=policy)
    steps.running_max("_made", F.when(F.col("event") == "created", place)).running_max("_gone", F.when(F.col("_is_end"), place))
    steps.next_match("_own_end", F.when(F.col("_is_end"), F.struct(*order, "_reason"))).lag("_made_before", "_made")
    opened = steps.done().filter("event = 'created'")
    closed_before = F.greatest("_before", "_gone")
    opened = opened.filter(F.col("_made_before").isNull() | (F.coalesce(F.col("_made_before") < closed_before, F.lit(False))))
    end = F.least("_after", "_own_end")
    items = F.array(
        F.struct(F.col(order[0]).alias("ts_ns"), F.lit("opened").alias("_event")),
        F.struct(end[order[0]].alias("ts_ns"), end["_reason"].alias("_event")),
    )
    found = opened.select("channel", "addr", F.inline(items)).filter("_event is not null")
    return found.select("channel", "addr", "ts_ns", _kind(F.col("_event"), CHANNEL_EVENT_KINDS).alias("kind"))


def connection_status_items(log: DataFrame) -> DataFrame:
    """Connection status items of the log."""
    kind = _kind(F.col("event"), CONNECTION_EVENT_KINDS)
    return log.select("addr", "ts_ns", kind.alias("kind")).filter("kind is not null and addr is not null")


def silences(
    log: DataFrame,
    now_ns: int,
    keys: Sequence[str] = ("addr",),
    silent_ns: int = 20 * SECOND,
    critical_ns: int = 10 * SECOND,
    order: Sequence[str] = ("ts_ns", "seq"),
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Silences of a key: `shutdown` when nothing came for `silent_ns`, `critical` some time later.

    The echo check is the same with 20 s and 4 s.
    """
    rows = Ordered(log.select(*keys, *order), keys, order, hot, policy).lead("_next", order[0]).done()
    until = F.coalesce("_next", F.lit(now_ns))
    at = F.col(order[0])
    stages = F.array(
        F.struct(F.lit("shutdown").alias("alarm"), (at + silent_ns).alias("alarm_ts_ns")),
        F.struct(F.lit("critical").alias("alarm"), (at + silent_ns + critical_ns).alias("alarm_ts_ns")),
    )
    return (
        rows.withColumn("_until", until)
        .filter(F.col("_until") - at > silent_ns)
        .select(*keys, "_until", F.inline(stages))
        .filter("alarm_ts_ns < _until")
        .drop("_until")
    )
