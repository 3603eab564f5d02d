"""Folds and bins over streams: the kernels of the table operators, with state kept per key.

The rows of a key in one micro-batch are put in time order before a kernel sees them; the trigger
limits of the source bound their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from seriesmill.functions.times import timestamp_of
from seriesmill.operators.fold import Chain
from seriesmill.operators.kernels import GridChange, IntervalGate, PartitionRoll
from seriesmill.operators.lifecycle import TRANSITION, Lifecycle, Timeouts
from seriesmill.operators.slicing import LOWEST
from seriesmill.schemas import DOUBLE, INT, LONG, MINUTE, SECOND, STRING, struct

ORDER = ["ts_ns", "seq"]
BUCKET = "series_bucket"
_PANDAS = {LONG: "Int64", T.BooleanType(): "boolean"}


def _ordered(rows: Iterator[pd.DataFrame], order: Sequence[str] = ORDER) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(list(order), ignore_index=True)


def _joined(parts: list[Any]) -> Any:
    """One kernel output from those of several runs."""
    return tuple(np.concatenate(p) for p in zip(*parts)) if isinstance(parts[0], tuple) else np.concatenate(parts)


def _series(value: Any) -> Any:
    """A kernel output as a pandas column."""
    if isinstance(value, tuple):
        data, mask = value
        if data.dtype.kind == "i":
            return pd.arrays.IntegerArray(data, mask)
        if data.dtype.kind == "b":
            return pd.arrays.BooleanArray(data, mask)
        return np.where(mask, np.nan, data)
    return value


class IngestProcessor(StatefulProcessor):
    """Gate, partition roll and grid flag of the series of one bucket; dropped rows leave only their reports.

    The state of all three is one value per series, read and written once per series and micro-batch. Only the
    kernels run series by series: the rows of a bucket are sorted, and its results put together, at once.
    """

    def __init__(self, gate: IntervalGate, layout: Chain, columns: list[str], series: T.StructType):
        self.gate, self.layout, self.columns, self.series = gate, layout, columns, series

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.store = handle.getMapState("layout", self.series, Chain(self.gate, *self.layout.steps).state)

    def _run(self, kernel, states: dict, rows: pd.DataFrame) -> pd.DataFrame:
        """The rows, which lie by series, with the kernel's columns; moves the states of their series on."""
        names, cols = rows["series"].to_numpy(), {c: rows[c].to_numpy() for c in kernel.inputs}
        starts = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        outs = []
        for at, end in zip(starts.tolist(), [*starts[1:].tolist(), len(names)]):
            states[names[at]], out = kernel.run(states[names[at]], {c: v[at:end] for c, v in cols.items()})
            outs.append(out)
        return rows.assign(**{n: _series(_joined([out[n] for out in outs])) for n in outs[0]})

    def handleInputRows(self, key, rows, timerValues):
        events, size = _ordered(rows, ("series", self.gate.ts, "seq")), len(self.gate.state)
        gates, layouts = {}, {}
        for name in events["series"].unique():
            stored = self.store.getValue((name,))
            gates[name] = self.gate.fresh() if stored is None else tuple(stored)[:size]
            layouts[name] = self.layout.fresh() if stored is None else tuple(stored)[size:]
        events = self._run(self.gate, gates, events)
        kept = events[events["admitted"]].sort_values(["series", *ORDER], ignore_index=True)
        if len(kept):
            yield self._run(self.layout, layouts, kept)[self.columns]
        for name, state in gates.items():
            self.store.updateValue((name,), (*state, *layouts[name]))
        told = events[events["report"] & ~events["admitted"]]
        if len(told):
            yield told.assign(**{f.name: pd.Series([None] * len(told), index=told.index, dtype=_PANDAS[f.dataType]) for f in self.layout.outputs})[self.columns]

    def close(self) -> None:
        pass


def lay_out_stream(
    events: DataFrame,
    gate: IntervalGate | None = None,
    roll: PartitionRoll | None = None,
    grid: GridChange | None = None,
    buckets: int = 2048,
) -> DataFrame:
    """Admitted events with their layout, and the interval reports of dropped ones (`admitted` false).

    The gate sees the rows in the order of its own clock, the layout the admitted ones in time order.
    With the time of arrival as the clock (`IntervalGate(ts=...)`), rows that come late are admitted.
    Series are dealt to buckets, whose rows of a micro-batch are handled together; null series have one of their
    own. The number of buckets is part of the state: a checkpoint goes on with the one it began with.
    """
    gate, layout = gate or IntervalGate(), Chain(roll or PartitionRoll(), grid or GridChange())
    series = events.schema["series"]
    bucket = F.when(F.col("series").isNull(), -1).otherwise(F.pmod(F.xxhash64("series"), F.lit(buckets))).cast("long")
    # A null would make numbers of a whole Arrow batch floats in pandas.
    dealt = events.select(bucket.alias(BUCKET), "*").withColumn("series", F.coalesce("series", F.lit(0).cast(series.dataType)))
    schema = T.StructType([T.StructField(BUCKET, LONG), *events.schema.fields, *gate.outputs.fields, *layout.outputs.fields])
    processor = IngestProcessor(gate, layout, schema.names, T.StructType([series]))
    laid_out = dealt.groupBy(BUCKET).transformWithStateInPandas(processor, schema, "append", "none")
    return laid_out.withColumn("series", F.when(F.col(BUCKET) >= 0, F.col("series"))).drop(BUCKET)


class PendingRows:
    """Rows of one key that the watermark has not reached, as sorted runs in blocks, each block one packed value.

    A run holds at most `RUN` rows. Taking rows merges the runs that have begun by then, one block of each in memory.
    """

    RUN, BLOCK = 1 << 18, 1 << 12
    ROW = np.dtype([("ts_ns", "<i8"), ("seq", "<i8"), ("value", "<f8")])

    def __init__(self, handle: StatefulProcessorHandle):
        self.runs = handle.getMapState("pending_runs", struct(run=LONG), struct(block=LONG, end=LONG, first=LONG))
        self.blocks = handle.getMapState("pending_blocks", struct(run=LONG, block=LONG), struct(rows=T.BinaryType()))

    def add(self, frames: Iterator[pd.DataFrame]) -> None:
        held, size = [], 0
        for pdf in frames:
            rows = np.empty(len(pdf), self.ROW)
            for name in self.ROW.names:
                rows[name] = pdf[name].to_numpy()
            held.append(rows)
            size += len(rows)
            if size >= self.RUN:
                self._add_run(np.concatenate(held))
                held, size = [], 0
        if size:
            self._add_run(np.concatenate(held))

    def _sorted(self, rows: np.ndarray) -> np.ndarray:
        return np.lexsort((rows["value"], rows["seq"], rows["ts_ns"]))

    def _add_run(self, rows: np.ndarray) -> None:
        rows = rows[self._sorted(rows)]
        run = max((k[0] for k in self.runs.keys()), default=-1) + 1
        starts = range(0, len(rows), self.BLOCK)
        for n, at in enumerate(starts):
            self.blocks.updateValue((run, n), (rows[at : at + self.BLOCK].tobytes(),))
        self.runs.updateValue((run,), (0, len(starts), int(rows["ts_ns"][0])))

    def first(self) -> int | None:
        return min((v[2] for v in self.runs.values()), default=None)

    def take(self, mark: int) -> Iterator[np.ndarray]:
        """The rows before a time, in order and part by part; they are forgotten."""
        ends, at, heads = {}, {}, {}
        for (run,), (block, end, first) in list(self.runs.iterator()):
            if first < mark:
                ends[run], at[run], heads[run] = end, block, self._block(run, block)
        while heads:
            # Up to the earliest last row of a block that is followed by another: nothing before it is still to come.
            names = list(heads)
            rows = np.concatenate([heads[r] for r in names])
            of = np.repeat(np.arange(len(names)), [len(heads[r]) for r in names])
            order = self._sorted(rows)
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            last = np.cumsum([len(heads[r]) for r in names]) - 1
            goes_on = [rank[e] for r, e in zip(names, last) if at[r] + 1 < ends[r]]
            rows = rows[order[: min(goes_on, default=len(order) - 1) + 1]]
            rows = rows[: np.searchsorted(rows["ts_ns"], mark)]
            taken = np.bincount(of[order[: len(rows)]], minlength=len(names))
            yield rows
            for r, n in zip(names, taken.tolist()):
                heads[r] = heads[r][n:]
                while not len(heads[r]) and at[r] < ends[r]:
                    self.blocks.removeKey((r, at[r]))
                    at[r] += 1
                    if at[r] < ends[r]:
                        heads[r] = self._block(r, at[r])
                if not len(heads[r]):
                    self.runs.removeKey((r,))
                    del heads[r]
                elif heads[r]["ts_ns"][0] >= mark:
                    self.blocks.updateValue((r, at[r]), (heads[r].tobytes(),))
                    self.runs.updateValue((r,), (at[r], ends[r], int(heads[r]["ts_ns"][0])))
                    del heads[r]

    def _block(self, run: int, block: int) -> np.ndarray:
        return np.frombuffer(bytes(self.blocks.getValue((run, block))[0]), self.ROW)


class BinProcessor(StatefulProcessor):
    """Time-weighted bins of one series, closed as the watermark passes their end.

    State: rows the watermark has not reached, the value carried on, and the open bin. A timer
    at the end of the open bin closes it also when the series has gone silent; the value is then
    carried on for at most `max_carry`.
    """

    def __init__(self, bin_ns: int, max_carry_ns: int, key: str):
        self.bin, self.max_carry, self.key = bin_ns, max_carry_ns, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = PendingRows(handle)
        self.open = handle.getValueState(
            "open",
            struct(bin=LONG, count=LONG, min=DOUBLE, max=DOUBLE, weighted=DOUBLE, weight=DOUBLE, ts_ns=LONG, at=LONG, value=DOUBLE),
        )

    def handleInputRows(self, key, rows, timerValues):
        self.pending.add(rows)
        yield from self._settle(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._settle(key, timerValues)

    def _settle(self, key, timerValues):
        """Fold what the watermark has passed, then close the bins that ended before it."""
        mark = timerValues.getCurrentWatermarkInMs() * 1_000_000
        bin_ = list(self.open.get()) if self.open.exists() else None
        for rows in self.pending.take(mark):
            closed = []
            for ts, value in zip(rows["ts_ns"].tolist(), rows["value"].tolist()):
                if bin_ is not None:
                    bin_ = self._carry(bin_, ts, closed)
                b = ts // self.bin
                if bin_ is None or bin_[0] != b:
                    if bin_ is not None:
                        closed.append(self._row(bin_))
                    bin_ = [b, 0, value, value, 0.0, 0.0, ts, ts, value]
                bin_[1] += 1
                bin_[2], bin_[3] = min(bin_[2], value), max(bin_[3], value)
                bin_[6], bin_[7], bin_[8] = ts, ts, value
            yield from self._frame(key, closed)
        closed = []
        if bin_ is not None:
            bin_ = self._carry(bin_, min(mark, bin_[6] + self.max_carry), closed)
            ended = (bin_[0] + 1) * self.bin <= mark
            if ended:
                closed.append(self._row(bin_))
                bin_ = None
        if bin_ is None:
            self.open.clear()
        else:
            self.open.update(tuple(bin_))
        self._set_timer(bin_, self.pending.first())
        yield from self._frame(key, closed)

    def _frame(self, key, closed):
        if closed:
            yield pd.DataFrame([(key[0], *r) for r in closed], columns=[self.key, "bin", "count", "min", "max", "avg"])

    def _carry(self, bin_, until, closed):
        """Hold the value until a time, at most for the carry limit, closing the bins it fills."""
        until = min(until, bin_[6] + self.max_carry)
        while bin_[7] < until:
            end = (bin_[0] + 1) * self.bin
            stop = min(end, until)
            if stop > bin_[7]:
                bin_[4] += bin_[8] * (stop - bin_[7])
                bin_[5] += stop - bin_[7]
                bin_[7] = stop
            if stop == end and end < until:
                closed.append(self._row(bin_))
                bin_ = [bin_[0] + 1, 0, bin_[8], bin_[8], 0.0, 0.0, bin_[6], end, bin_[8]]
        return bin_

    def _row(self, b):
        return b[0], b[1], b[2], b[3], b[4] / b[5] if b[5] > 0 else b[8]

    def _set_timer(self, bin_, first):
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = []
        if bin_ is not None:
            due.append((bin_[0] + 1) * self.bin)
        if first is not None:
            due.append(first + 1_000_000)
        if due:
            self.handle.registerTimer(min(due) // 1_000_000 + 1)

    def close(self) -> None:
        pass


def bin_stream(
    events: DataFrame, bin_ns: int = MINUTE, delay: str = "10 seconds", key: str = "series", *, max_carry_ns: int
) -> DataFrame:
    """Time-weighted bins of a stream of events, each given once when the watermark passes its end.

    Rows without a time are left out.
    """
    kind = events.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *struct(bin=LONG, count=LONG, min=DOUBLE, max=DOUBLE, avg=DOUBLE).fields])
    rows = events.select(key, "ts_ns", F.coalesce("seq", F.lit(LOWEST)).alias("seq"), "value").filter("ts_ns is not null")
    timed = rows.withColumn("event_time", timestamp_of()).withWatermark("event_time", delay)
    return timed.groupBy(key).transformWithStateInPandas(BinProcessor(bin_ns, max_carry_ns, key), schema, "append", "eventTime")


class LifecycleProcessor(StatefulProcessor):
    """Lifecycle transitions of one channel; stays end by event-time timers."""

    def __init__(self, timeouts: Timeouts):
        self.kernel = Lifecycle(timeouts)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.kernel.state)

    def _emit(self, key, passed):
        if passed:
            yield pd.DataFrame([(key[0], *p) for p in passed], columns=["channel", *TRANSITION.names])

    def _set_timer(self, state):
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = self.kernel.due(state)
        if due is not None:
            self.handle.registerTimer(-(-due // 1_000_000))

    def handleInputRows(self, key, rows, timerValues):
        log = _ordered(rows)
        before = tuple(self.state.get()) if self.state.exists() else self.kernel.fresh()
        cols = {"ts_ns": log["ts_ns"].to_numpy(), "event": log["event"].tolist(), "addr": [None if pd.isna(a) else a for a in log["addr"]]}
        state, out = self.kernel.run(before, cols)
        self.state.update(state)
        self._set_timer(state)
        passed = [tuple(p.values()) for row in out["transitions"].to_pylist() for p in row]
        yield from self._emit(key, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs() * 1_000_000
        state, passed = self.kernel.advance(tuple(self.state.get()), mark)
        self.state.update(state)
        self._set_timer(state)
        yield from self._emit(key, passed)

    def close(self) -> None:
        pass


def lifecycle_stream(log: DataFrame, timeouts: Timeouts = Timeouts(), delay: str = "0 seconds") -> DataFrame:
    """Transitions of a stream of lifecycle events."""
    schema = T.StructType([T.StructField("channel", STRING), *TRANSITION.fields])
    timed = log.withColumn("event_time", timestamp_of()).withWatermark("event_time", delay)
    return timed.groupBy("channel").transformWithStateInPandas(LifecycleProcessor(timeouts), schema, "append", "eventTime")


class SilenceProcessor(StatefulProcessor):
    """Alarms of one key that has gone silent."""

    def __init__(self, silent_ns: int, critical_ns: int, key: str):
        self.silent, self.critical, self.key = silent_ns, critical_ns, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", struct(ts_ns=LONG, stage=INT))

    def _due(self, last, stage):
        return last + self.silent + (self.critical if stage else 0)

    def _pass(self, last, stage, until, alarms):
        """Raise the alarms due before a time."""
        while stage < 2 and self._due(last, stage) < until:
            alarms.append(("critical" if stage else "shutdown", self._due(last, stage)))
            stage += 1
        return stage

    def _finish(self, key, last, stage, alarms):
        self.last.update((last, stage))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if stage < 2:
            self.handle.registerTimer(self._due(last, stage) // 1_000_000 + 1)
        if alarms:
            yield pd.DataFrame([(key[0], *a) for a in alarms], columns=[self.key, "alarm", "alarm_ts_ns"])

    def handleInputRows(self, key, rows, timerValues):
        alarms = []
        last, stage = tuple(self.last.get()) if self.last.exists() else (None, 0)
        for ts in sorted(t for pdf in rows for t in pdf["ts_ns"].tolist()):
            if last is not None and ts >= last:
                self._pass(last, stage, ts, alarms)
            if last is None or ts >= last:
                last, stage = ts, 0
        yield from self._finish(key, last, stage, alarms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        alarms = []
        last, stage = tuple(self.last.get())
        stage = self._pass(last, stage, timerValues.getCurrentWatermarkInMs() * 1_000_000, alarms)
        yield from self._finish(key, last, stage, alarms)

    def close(self) -> None:
        pass


def silence_stream(
    log: DataFrame, key: str = "addr", silent_ns: int = 20 * SECOND, critical_ns: int = 10 * SECOND, delay: str = "0 seconds"
) -> DataFrame:
    """Alarms of a stream of status rows. The watermark is the clock."""
    schema = T.StructType([log.schema[key], *struct(alarm=STRING, alarm_ts_ns=LONG).fields])
    timed = log.select(key, "ts_ns", timestamp_of().alias("event_time")).withWatermark("event_time", delay)
    return timed.groupBy(key).transformWithStateInPandas(
        SilenceProcessor(silent_ns, critical_ns, key), schema, "append", "eventTime"
    )
