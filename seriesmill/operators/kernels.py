"""The folds themselves: moving averages, partition roll, gates and limiters."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np

from seriesmill.operators.fold import Kernel, Paths, Transfer
from seriesmill.schemas import BOOL, DOUBLE, HOUR, INTS, LONG, LONGS, SECOND, struct


def decay_scan(start: float, keep: float, added: np.ndarray) -> np.ndarray:
    """y[i] = keep * y[i-1] + added[i] from y[-1] = start, in log2(n) array steps."""
    y = added.astype(np.float64)
    if len(y) == 0:
        return y
    y[0] += keep * start
    step, factor = 1, keep
    while step < len(y) and factor != 0.0:
        y[step:] += factor * y[:-step]
        factor *= factor
        step *= 2
    return y


def ema_update(ema: float, emv: float, k: float, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moving average and variance after each of `values`."""
    emas = decay_scan(ema, 1.0 - k, k * values)
    before = np.concatenate(([ema], emas[:-1]))
    dv = values - before
    return emas, decay_scan(emv, 1.0 - k, (1.0 - k) * k * dv * dv)


class Moments(Paths):
    """How a run of values moves an average and its variance, whatever they were before.

    The average after is `factor * ema + shift`; the variance `factor * emv + a + b * ema + c * ema^2`.
    Runs compose, so a slice of any length is six numbers.
    """

    def __init__(self, k: float):
        self.k, self.size = k, 0
        self.factor, self.shift, self.a, self.b, self.c = 1.0, 0.0, 0.0, 0.0, 0.0

    def extend(self, values: np.ndarray) -> None:
        m, keep = len(values), 1.0 - self.k
        if not m:
            return
        emas, emvs = ema_update(0.0, 0.0, self.k, values)
        fade = keep ** np.arange(m)  # what is left of the average before each value
        weight = fade[::-1] * keep * self.k  # of each squared difference in the variance after
        apart = values - np.concatenate(([0.0], emas[:-1]))
        factor, shift, a = keep**m, float(emas[-1]), float(emvs[-1])
        b, c = float(-2.0 * (weight * apart * fade).sum()), float((weight * fade * fade).sum())
        self.a = factor * self.a + a + b * self.shift + c * self.shift**2
        self.b = factor * self.b + b * self.factor + 2.0 * c * self.shift * self.factor
        self.c = factor * self.c + c * self.factor**2
        self.shift = factor * self.shift + shift
        self.factor *= factor
        self.size += m

    def numbers(self) -> dict:
        return {"size": self.size, "factor": self.factor, "shift": self.shift, "a": self.a, "b": self.b, "c": self.c}


MOMENTS = dict(size=LONG, factor=DOUBLE, shift=DOUBLE, a=DOUBLE, b=DOUBLE, c=DOUBLE)


def moved(ema: float, emv: float, m: dict) -> tuple[float, float]:
    return m["factor"] * ema + m["shift"], m["factor"] * emv + m["a"] + m["b"] * ema + m["c"] * ema * ema


class ValueMoments(Moments):
    def __init__(self, kernel):
        super().__init__(kernel.k)
        self.value = kernel.value

    def add(self, cols):
        self.extend(cols[self.value].astype(np.float64))

    def result(self):
        return self.numbers()


class ValueEma(Transfer):
    """Moving average and variance of a value column."""

    state = struct(ema=DOUBLE, emv=DOUBLE, n=LONG)
    outputs = struct(ema=DOUBLE, emv=DOUBLE, ema_count=LONG)
    summary = struct(**MOMENTS)

    def __init__(self, k: float = 0.05, value: str = "value"):
        self.k, self.value = k, value
        self.inputs = (value,)

    def fresh(self):
        return 0.0, 0.0, 0

    def paths(self):
        return ValueMoments(self)

    def cross(self, state, summary):
        ema, emv, n = state
        return *moved(ema, emv, summary), n + summary["size"]

    def run(self, state, cols):
        ema, emv, n = state
        values = cols[self.value].astype(np.float64)
        emas, emvs = ema_update(ema, emv, self.k, values)
        counts = n + 1 + np.arange(len(values), dtype=np.int64)
        out = {"ema": emas, "emv": emvs, "ema_count": counts}
        return (float(emas[-1]), float(emvs[-1]), int(counts[-1])), out


class IntervalMoments(Moments):
    """Moments of the gaps within a slice, and its first and last time for the gap before it."""

    def __init__(self, kernel):
        super().__init__(kernel.k)
        self.ts, self.first, self.last = kernel.ts, None, None

    def add(self, cols):
        ts = cols[self.ts]
        if self.first is None:
            self.first = int(ts[0])
            self.extend(np.diff(ts) / 1e9)
        else:
            self.extend(np.diff(ts, prepend=self.last) / 1e9)
        self.last = int(ts[-1])

    def result(self):
        return {**self.numbers(), "first": self.first, "last": self.last}


class IntervalEma(Transfer):
    """Moving average and variance of the seconds between rows; the first row of a key updates nothing."""

    state = struct(ema=DOUBLE, emv=DOUBLE, n=LONG, last=LONG)
    outputs = struct(ema=DOUBLE, emv=DOUBLE, ema_count=LONG)
    summary = struct(**MOMENTS, first=LONG, last=LONG)

    def __init__(self, k: float = 0.05, ts: str = "ts_ns"):
        self.k, self.ts = k, ts
        self.inputs = (ts,)

    def fresh(self):
        return 0.0, 0.0, 0, None

    def paths(self):
        return IntervalMoments(self)

    def cross(self, state, summary):
        ema, emv, n, last = state
        if last is not None:
            apart = (summary["first"] - last) / 1e9 - ema
            ema, emv, n = ema + self.k * apart, (1.0 - self.k) * (emv + self.k * apart * apart), n + 1
        return *moved(ema, emv, summary), n + summary["size"], summary["last"]

    def run(self, state, cols):
        ema, emv, n, last = state
        ts = cols[self.ts]
        first = last is None
        gaps = np.diff(ts, prepend=ts[0] if first else last) / 1e9
        if first:
            emas, emvs = ema_update(ema, emv, self.k, gaps[1:])
            emas, emvs = np.concatenate(([ema], emas)), np.concatenate(([emv], emvs))
        else:
            emas, emvs = ema_update(ema, emv, self.k, gaps)
        counts = n + np.arange(len(ts), dtype=np.int64) + (0 if first else 1)
        none = counts == 0
        out = {"ema": (emas, none), "emv": (emvs, none), "ema_count": counts}
        return (float(emas[-1]), float(emvs[-1]), int(counts[-1]), int(ts[-1])), out


class StartRows(Paths):
    """Rows of a slice at which a kernel can first change state, and where each of them leads.

    A kernel gives three rules: which rows can be first, the state right after one, and how a set
    of states moves through a batch. Rows that lead to the same state share a path.
    """

    # paths that are sorted after every batch to find equal ones; more are sorted now and then
    FEW = 2000

    def __init__(self, kernel):
        self.kernel = kernel
        self.size, self.open, self.batches = 0, True, 0
        self.first_ts = None
        self.ts: list[np.ndarray] = []
        self.path = np.zeros(0, dtype=np.int64)
        self.states = np.zeros((kernel.width, 0), dtype=np.int64)

    def add(self, cols):
        ts = cols[self.kernel.ts_column]
        if self.first_ts is None:
            self.first_ts = int(ts[0])
        if self.states.shape[1]:
            self.kernel.move(self.states, np.zeros(self.states.shape[1], dtype=np.int64), ts)
        if self.open:
            n = self.kernel.can_be_first(self, ts)
            self.open = n == len(ts)
            if n:
                new = self.kernel.after_first(ts[:n])
                self.kernel.move(new, np.arange(1, n + 1), ts)
                self.path = np.append(self.path, self.states.shape[1] + np.arange(n))
                self.states = np.hstack((self.states, new))
                self.ts.append(ts[:n])
        self.size += len(ts)
        self.batches += 1
        if self.states.shape[1] <= self.FEW or self.batches % 16 == 0:
            self._merge()

    def _merge(self):
        """Give rows with equal states one path."""
        if self.states.shape[1] < 2:
            return
        order = np.lexsort(self.states)
        ranked = self.states[:, order]
        new = np.concatenate(([True], (ranked[:, 1:] != ranked[:, :-1]).any(axis=0)))
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        self.states, self.path = ranked[:, new], number[self.path]

    def result(self):
        self._merge()
        ts = np.concatenate(self.ts)
        named = {n: self.states[i].tolist() for i, n in enumerate(self.kernel.exit_names)}
        return {"size": self.size, "ts": ts.tolist(), "path": self.path.tolist(), **named}


class PartitionRoll(Transfer):
    """Partition timestamp of every row: a new one after `max_rows` rows or `span` of time.

    Jumps from roll to roll by binary search, so the work in Python grows with the number of
    partitions, not of rows.
    """

    state = struct(msp=LONG, n=LONG)
    outputs = struct(ts_msp=LONG, msp_bump=BOOL, late=BOOL)
    summary = struct(size=LONG, ts=LONGS, path=INTS, exit_msp=LONGS, exit_n=LONGS)
    inputs = ("ts_ns",)
    ts_column, width, exit_names = "ts_ns", 2, ("exit_msp", "exit_n")

    def __init__(self, max_rows: int = 64_000, span_ns: int = HOUR, floor_ns: int = 10 * SECOND):
        self.max_rows, self.span, self.floor = max_rows, span_ns, floor_ns

    def fresh(self):
        return None, 0

    def paths(self):
        return StartRows(self)

    def can_be_first(self, rows: StartRows, ts: np.ndarray) -> int:
        """How many more rows can be the first roll: none later than a state entered just before would roll."""
        new_cell = np.searchsorted(ts, rows.first_ts + self.floor)
        in_time = np.searchsorted(ts, rows.first_ts + max(self.span, self.floor)) + 1
        by_count = max(self.max_rows - rows.size, int(new_cell)) + 1
        return int(max(0, min(by_count, in_time, len(ts))))

    def after_first(self, ts: np.ndarray) -> np.ndarray:
        return np.vstack((ts - ts % self.floor, np.ones(len(ts), dtype=np.int64)))

    def move(self, states: np.ndarray, at: np.ndarray, ts: np.ndarray) -> None:
        """Move states through a batch, each from its own position."""
        msp, n = states
        size = len(ts)
        live = np.flatnonzero(at < size)
        while len(live):
            m, c, i = msp[live], n[live], at[live]
            full = np.maximum(i + np.maximum(0, self.max_rows - c), np.searchsorted(ts, m + self.floor))
            old = np.searchsorted(ts, m + max(self.span, self.floor))
            roll = np.minimum(np.maximum(i, np.minimum(full, old)), size)
            n[live] = np.maximum(c, np.minimum(c + roll - i, self.max_rows))
            at[live] = roll + 1
            rolls, where = live[roll < size], roll[roll < size]
            msp[rolls], n[rolls] = ts[where] - ts[where] % self.floor, 1
            live = live[at[live] < size]

    def cross(self, state, summary):
        msp, n = state
        ts = summary["ts"]
        first = 0
        if msp is not None:
            full = max(0, self.max_rows - n, int(np.searchsorted(ts, msp + self.floor)))
            first = min(full, int(np.searchsorted(ts, msp + max(self.span, self.floor))))
        if first >= len(ts):
            return msp, max(n, min(n + summary["size"], self.max_rows))
        path = summary["path"][first]
        return int(summary["exit_msp"][path]), int(summary["exit_n"][path])

    def run(self, state, cols):
        msp, n = state
        ts = cols["ts_ns"]
        size = len(ts)
        part = np.empty(size, dtype=np.int64)
        bump = np.zeros(size, dtype=bool)
        late = np.zeros(size, dtype=bool)
        i = 0
        if msp is not None:
            i = int(np.searchsorted(ts, msp))
            part[:i] = ts[:i] - ts[:i] % self.floor
            late[:i] = True
        while i < size:
            if msp is None:
                roll = i
            else:
                full = max(i + max(0, self.max_rows - n), int(np.searchsorted(ts, msp + self.floor)))
                old = int(np.searchsorted(ts, msp + max(self.span, self.floor)))
                roll = min(max(i, min(full, old)), size)
                part[i:roll] = msp
                n = max(n, min(n + roll - i, self.max_rows))
            if roll < size:
                msp, n = int(ts[roll] - ts[roll] % self.floor), 1
                part[roll], bump[roll] = msp, True
            i = roll + 1
        return (msp, n), {"ts_msp": part, "msp_bump": bump, "late": late}


class IntervalGate(Kernel):
    """Admit rows at a minimum interval that adapts to the interval really admitted.

    Dropped rows report the interval statistics, at most once per `report_ns` and key. `ts` is the
    clock: the rows must come in its order, so a gate on the time of arrival lets a row of an
    earlier device time pass like any other.
    """

    state = struct(ema=DOUBLE, emv=DOUBLE, known=BOOL, last=LONG, next=LONG, reported=LONG)
    outputs = struct(admitted=BOOL, ivl_ema=DOUBLE, report=BOOL, report_ema=DOUBLE, report_emd=DOUBLE)

    def __init__(self, ivl_ns: int = 6_000_000, k: float = 0.05, report_ns: int = 10 * SECOND, ts: str = "ts_ns"):
        self.ivl, self.k, self.report_ns, self.ts = ivl_ns / 1e9, k, report_ns, ts
        self.inputs = (ts,)

    def fresh(self):
        return 0.0, 0.0, False, None, None, None

    def run(self, state, cols):
        ema, emv, known, last, nxt, reported = state
        k, ivl = self.k, self.ivl
        t = cols[self.ts].tolist()
        size = len(t)
        admitted = np.zeros(size, dtype=bool)
        emas = np.zeros(size)
        unset = np.zeros(size, dtype=bool)
        report = np.zeros(size, dtype=bool)
        emd = np.zeros(size)
        if reported is None:
            reported = t[0]
        i = 0
        while i < size:
            now = t[i]
            if nxt is None or now >= nxt:
                if last is not None:
                    dv = (now - last) / 1e9 - ema
                    ema += k * dv
                    emv = (1.0 - k) * (emv + k * dv * dv)
                    known = True
                last = now
                nxt = now + int(max(0.0, ivl - ema) / k * 1e6) * 1000
                admitted[i], emas[i], unset[i] = True, ema, not known
                i += 1
                continue
            stop = bisect_left(t, nxt, i)
            emas[i:stop], unset[i:stop] = ema, not known
            r = bisect_left(t, reported + self.report_ns, i, stop)
            while r < stop:
                report[r], emd[r], reported = True, emv**0.5, t[r]
                r = bisect_left(t, reported + self.report_ns, r + 1, stop)
            i = stop
        out = {
            "admitted": admitted,
            "ivl_ema": (emas, unset),
            "report": report,
            "report_ema": (emas, ~report),
            "report_emd": (emd, ~report),
        }
        return (ema, emv, known, last, nxt, reported), out


class RateLimiter(Kernel):
    """Drop droppable items while the previewed forwarding interval is below `1 / rate`."""

    state = struct(ema=DOUBLE, last=LONG)
    outputs = struct(forwarded=BOOL, forward_ema=DOUBLE)

    def __init__(
        self,
        rate: float = 5000.0,
        k: float = 1e-5,
        cap_ns: int = SECOND // 10,
        initial_ema: float | None = None,
        ts: str = "ts_ns",
        droppable: str = "droppable",
    ):
        self.k, self.cap, self.ts, self.droppable = k, cap_ns, ts, droppable
        self.least = 1.0 / rate
        self.initial = self.least if initial_ema is None else initial_ema
        self.inputs = (ts, droppable)

    def fresh(self):
        return self.initial, None

    def run(self, state, cols):
        ema, last = state
        k, cap, least = self.k, self.cap, self.least
        ts, droppable = cols[self.ts], cols[self.droppable].astype(bool)
        t, kept = ts.tolist(), np.flatnonzero(~droppable)
        size = len(t)
        forwarded, emas = np.zeros(size, dtype=bool), np.zeros(size)
        preview = lambda now: ema + k * (min(now - last, cap) / 1e9 - ema)
        i = 0
        while i < size:
            if last is not None:
                # the preview rises with time, so the first row that passes is found by search
                at = kept.searchsorted(i)
                stop = int(kept[at]) if at < len(kept) else size
                passing = bisect_left(t, True, i, stop, key=lambda now: preview(now) >= least)
                emas[i:passing] = ema
                if (i := passing) == size:
                    break
                ema = preview(t[i])
            last = t[i]
            forwarded[i], emas[i] = True, ema
            i += 1
        return (ema, last), {"forwarded": forwarded, "forward_ema": emas}


class Throttle(Transfer):
    """Emit the first row of a key, then at most one row per `every_ns`."""

    state = struct(last=LONG)
    outputs = struct(emitted=BOOL)
    summary = struct(size=LONG, ts=LONGS, path=INTS, exit_last=LONGS)
    width, exit_names = 1, ("exit_last",)

    def __init__(self, every_ns: int = 10 * SECOND, ts: str = "ts_ns"):
        self.every, self.ts_column = every_ns, ts
        self.inputs = (ts,)

    def fresh(self):
        return (None,)

    def paths(self):
        return StartRows(self)

    def can_be_first(self, rows: StartRows, ts: np.ndarray) -> int:
        return int(min(np.searchsorted(ts, rows.first_ts + self.every) + 1, len(ts)))

    def after_first(self, ts: np.ndarray) -> np.ndarray:
        return ts.reshape(1, -1).copy()

    def move(self, states: np.ndarray, at: np.ndarray, ts: np.ndarray) -> None:
        last = states[0]
        live = np.flatnonzero(at < len(ts))
        while len(live):
            at[live] = np.maximum(at[live], np.searchsorted(ts, last[live] + self.every))
            live = live[at[live] < len(ts)]
            last[live] = ts[at[live]]
            at[live] += 1

    def cross(self, state, summary):
        (last,) = state
        first = 0 if last is None else int(np.searchsorted(summary["ts"], last + self.every))
        if first >= len(summary["ts"]):
            return state
        return (int(summary["exit_last"][summary["path"][first]]),)

    def run(self, state, cols):
        (last,) = state
        t = cols[self.ts_column].tolist()
        emitted = np.zeros(len(t), dtype=bool)
        i = 0 if last is None else bisect_left(t, last + self.every)
        while i < len(t):
            emitted[i], last = True, t[i]
            i = bisect_left(t, last + self.every, i + 1)
        return (last,), {"emitted": emitted}


class GridChange(Kernel):
    """The grid cell of a row where it differs from the one before."""

    state = struct(cell=LONG)
    outputs = struct(ts_msp_grid=LONG)
    inputs = ("ts_ns",)

    def __init__(self, unit: int = 10 * SECOND, spacing: int = 30):
        self.unit, self.spacing = unit, spacing

    def fresh(self):
        return (0,)

    def run(self, state, cols):
        cells = cols["ts_ns"] // self.unit // self.spacing * self.spacing
        before = np.concatenate((state, cells[:-1]))
        return (int(cells[-1]),), {"ts_msp_grid": (cells, cells == before)}
