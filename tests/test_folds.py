"""Kernels against row-by-row rules, in one piece, in random pieces, and in Spark slices."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.operators import kernels as K, lifecycle
from seriesmill.operators.fold import Chain, fold
from seriesmill.operators.lifecycle import CYCLE, Lifecycle, LifecycleSteps, Timeouts, respond
from seriesmill.operators.slicing import SlicePolicy
from seriesmill.schemas import SECOND

SMALL = SlicePolicy(max_rows=40)


def plain(out, i):
    """Outputs of row i as Python values."""
    got = {}
    for name, v in out.items():
        if isinstance(v, tuple):
            got[name] = None if v[1][i] else v[0][i].item()
        else:
            got[name] = v[i].as_py() if hasattr(v[i], "as_py") else v[i].item()
    return got


def rows_of(kernel, cols, cuts):
    """Run a kernel over pieces of the input."""
    n = len(next(iter(cols.values())))
    state, got = kernel.fresh(), []
    edges = [0, *sorted({c for c in cuts if 0 < c < n}), n]
    for a, b in zip(edges, edges[1:]):
        state, out = kernel.run(state, {c: v[a:b] for c, v in cols.items()})
        got += [plain(out, i) for i in range(b - a)]
    return got


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def assert_rows(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(same(g[k], w[k]) for k in w), (g, w)


def ema_rule(values, k):
    ema = emv = 0.0
    for n, v in enumerate(values, 1):
        dv = v - ema
        ema += k * dv
        emv = (1 - k) * (emv + k * dv * dv)
        yield {"ema": ema, "emv": emv, "ema_count": n}


def interval_rule(ts, k):
    yield {"ema": None, "emv": None, "ema_count": 0}
    yield from ema_rule([(b - a) / 1e9 for a, b in zip(ts, ts[1:])], k)


def roll_rule(ts, max_rows, span, floor):
    msp, n = 0, math.inf
    for t in ts:
        bump = False
        if n >= max_rows or msp + span <= t:
            f = t - t % floor
            if f != msp:
                msp, n, bump = f, 1, True
        else:
            n += 1
        yield {"ts_msp": msp, "msp_bump": bump, "late": False}


def gate_rule(ts, ivl, k, report):
    ema = emv = 0.0
    n, last, nxt, reported = 0, None, -math.inf, ts[0]
    for t in ts:
        admitted = t >= nxt
        said = False
        if admitted:
            if last is not None:
                dv = (t - last) / 1e9 - ema
                ema += k * dv
                emv = (1 - k) * (emv + k * dv * dv)
                n += 1
            last = t
            nxt = t + int(max(0.0, ivl / 1e9 - ema) / k * 1e6) * 1000
        elif t - reported >= report:
            said, reported = True, t
        yield {
            "admitted": admitted,
            "ivl_ema": ema if n else None,
            "report": said,
            "report_ema": ema if said else None,
            "report_emd": math.sqrt(emv) if said else None,
        }


def throttle_rule(ts, every):
    last = None
    for t in ts:
        emitted = last is None or t - last >= every
        last = t if emitted else last
        yield {"emitted": emitted}


times = st.lists(st.integers(0, 30_000_000_000), min_size=1, max_size=200).map(
    lambda gaps: np.cumsum(np.array(gaps, dtype=np.int64)) + 1_700_000_000_000_000_000
)
cuts = st.lists(st.integers(1, 199), max_size=6)


@settings(max_examples=60, deadline=None)
@given(times, cuts)
def test_roll(ts, cuts):
    kernel = K.PartitionRoll(7, 120_000_000_000, 10_000_000_000)
    assert_rows(rows_of(kernel, {"ts_ns": ts}, cuts), list(roll_rule(ts.tolist(), 7, 120_000_000_000, 10_000_000_000)))


@settings(max_examples=60, deadline=None)
@given(times, cuts)
def test_gate(ts, cuts):
    kernel = K.IntervalGate(20_000_000_000, 0.05, 60_000_000_000)
    want = list(gate_rule(ts.tolist(), 20_000_000_000, 0.05, 60_000_000_000))
    assert_rows(rows_of(kernel, {"ts_ns": ts}, cuts), want)


@settings(max_examples=60, deadline=None)
@given(times, cuts)
def test_interval_ema_and_throttle(ts, cuts):
    assert_rows(rows_of(K.IntervalEma(0.05), {"ts_ns": ts}, cuts), list(interval_rule(ts.tolist(), 0.05)))
    assert_rows(rows_of(K.Throttle(45_000_000_000), {"ts_ns": ts}, cuts), list(throttle_rule(ts.tolist(), 45_000_000_000)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=300), cuts)
def test_value_ema(values, cuts):
    got = rows_of(K.ValueEma(0.05), {"value": np.array(values)}, cuts)
    for g, w in zip(got, ema_rule(values, 0.05)):
        assert math.isclose(g["ema"], w["ema"], rel_tol=1e-7, abs_tol=1e-6)
        assert math.isclose(g["emv"], w["emv"], rel_tol=1e-7, abs_tol=1e-2)


def test_rate_limiter_passes_what_may_not_be_dropped():
    ts = np.arange(100, dtype=np.int64) * 1_000_000
    keep = np.arange(100) % 10 == 0
    kernel = K.RateLimiter(rate=100.0, k=0.2)
    got = rows_of(kernel, {"ts_ns": ts, "droppable": ~keep}, [13, 50])
    assert all(g["forwarded"] for g, k in zip(got, keep) if k)
    assert sum(g["forwarded"] for g in got) < 30


def crossed(kernel, ts, cuts, batch):
    """State after all slices, from their summaries alone."""
    state = kernel.fresh()
    edges = [0, *sorted({c for c in cuts if 0 < c < len(ts)}), len(ts)]
    states = []
    for a, b in zip(edges, edges[1:]):
        paths = kernel.paths()
        for i in range(a, b, batch):
            paths.add({"ts_ns": ts[i : min(i + batch, b)]})
        summary = {k: np.array(v) if isinstance(v, list) else v for k, v in paths.result().items()}
        state = kernel.cross(state, summary)
        states.append(state)
    return edges[1:], states


@settings(max_examples=150, deadline=None)
@given(times, cuts, st.integers(1, 50), st.sampled_from([1, 5, 60]), st.sampled_from([1, 10, 40]), st.sampled_from([20, 120]))
def test_summaries_lead_to_the_same_states(ts, cuts, batch, max_rows, floor, span):
    for kernel in (K.PartitionRoll(max_rows, span * 10**9, floor * 10**9), K.Throttle(floor * 10**9)):
        ends, states = crossed(kernel, ts, cuts, batch)
        for end, state in zip(ends, states):
            assert state == kernel.run(kernel.fresh(), {"ts_ns": ts[:end]})[0]


def test_late_rows_get_their_own_floor():
    kernel = K.PartitionRoll(100, 3_600_000_000_000, 10)
    state, _ = kernel.run(kernel.fresh(), {"ts_ns": np.array([1005], dtype=np.int64)})
    state, out = kernel.run(state, {"ts_ns": np.array([987, 1006], dtype=np.int64)})
    assert out["late"].tolist() == [True, False]
    assert out["ts_msp"].tolist() == [980, 1000]


def test_chain_feeds_kept_rows_only():
    ts = np.cumsum(np.full(300, 3_000_000_000, dtype=np.int64)) + 1_700_000_000_000_000_000
    gate, roll = K.IntervalGate(20_000_000_000, 0.05), K.PartitionRoll(7, 120_000_000_000, 10_000_000_000)
    got = rows_of(Chain(gate, roll, keep="admitted"), {"ts_ns": ts}, [5, 6, 7, 150])
    admitted = [i for i, r in enumerate(gate_rule(ts.tolist(), 20_000_000_000, 0.05, 10**10)) if r["admitted"]]
    assert [i for i, g in enumerate(got) if g["admitted"]] == admitted
    want = list(roll_rule(ts[admitted].tolist(), 7, 120_000_000_000, 10_000_000_000))
    assert_rows([{k: got[i][k] for k in want[0]} for i in admitted], want)
    assert all(g["ts_msp"] is None for g in got if not g["admitted"])


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows belong to one series, and a third of those to one busy minute."""
    rng = random.Random(7)
    rows, seq = [], 0
    for series, n in [(1, 600), (2, 200), (3, 30), (None, 25)] + [(s, 5) for s in range(10, 60)]:
        t = 1_700_000_000_000_000_000
        for i in range(n):
            t += rng.choice([0, 1, 20, 300]) * 1_000_000_000 if i % 3 else rng.randrange(10**7)
            rows.append((series, t, seq, rng.random() * 100, rng.choice(["add", "series", "found", "not_found"]), "a:1", rng.random() < 0.7))
            seq += 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "series long, ts_ns long, seq long, value double, event string, addr string, droppable boolean")


@pytest.mark.parametrize(
    "kernel",
    [
        K.ValueEma(),
        K.IntervalEma(),
        K.PartitionRoll(5, 3_600_000_000_000),
        K.IntervalGate(30_000_000_000),
        K.RateLimiter(1 / 60, 0.1, 300_000_000_000),
        K.Throttle(200_000_000_000),
        K.GridChange(),
        Chain(K.IntervalGate(30_000_000_000), K.PartitionRoll(5), K.GridChange(), keep="admitted"),
        Lifecycle(Timeouts()),
    ],
    ids=lambda k: type(k).__name__,
)
def test_slices_equal_one_pass(spark, skewed, kernel):
    by_seq = lambda df: [r.asDict(recursive=True) for r in sorted(df.collect(), key=lambda r: r["seq"])]
    whole, sliced = by_seq(fold(skewed, ["series"], kernel)), by_seq(fold(skewed, ["series"], kernel, policy=SMALL))
    assert_rows(sliced, whole)


@pytest.mark.parametrize("kernel", [K.ValueEma(0.05), K.IntervalEma(0.05), K.IntervalGate(20_000_000_000, 0.05), K.RateLimiter(1 / 30, 0.1, 10**12)], ids=lambda k: type(k).__name__)
def test_jobs_do_not_grow_with_the_slices(spark, kernel):
    rows = spark.range(2400).selectExpr(
        "1L AS series", "id * 7000000000 + (id * id % 13) * 300000000 AS ts_ns", "id AS seq", "CAST(id % 17 AS DOUBLE) AS value", "id % 5 > 0 AS droppable"
    )
    plain = fold(rows, ["series"], kernel).orderBy("seq").collect()
    jobs = {}
    for slices in (12, 24):
        group = f"{type(kernel).__name__}-{slices}"
        spark.sparkContext.setJobGroup(group, "sliced fold")
        got = fold(rows, ["series"], kernel, policy=SlicePolicy(max_rows=2400 // slices)).orderBy("seq").collect()
        jobs[slices] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        for a, b in zip(plain, got, strict=True):
            assert a.asDict() == {c: pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v for c, v in b.asDict().items()}
    assert jobs[24] <= jobs[12] + 8


def test_timeouts_in_closed_form(spark):
    """Counted time-outs equal those walked one by one; a year of silence is one row of the fold."""
    rng = random.Random(5)
    for _ in range(300):
        limits = Timeouts(*[rng.randint(1, 9) for _ in range(4)])
        walked, counted = Lifecycle(limits), LifecycleSteps(limits)
        state = (rng.choice(["none", "init", "wait_status_series", *CYCLE, "assigned"]), rng.randint(0, 5), rng.choice([None, "a"]))
        now = rng.randint(0, 200)
        after, passed = walked.advance(state, now)
        assert counted.skip(state, now) == (after, len(passed))
    year = 365 * 86_400 * SECOND
    rows = [("c", 0, 0, "add", None), ("c", SECOND, 1, "series", None), ("c", year, 2, "remove", None), ("d", 0, 3, "add", None), ("d", year, 4, "add", None)]
    log = spark.createDataFrame(rows, "channel string, ts_ns long, seq long, event string, addr string")
    got = [tuple(r)[1:] for r in lifecycle.transitions(log).filter("channel = 'c'").orderBy("ts_ns").collect()]
    state, want = ("none", 0, None), []
    for _, ts, _, event, addr in rows[:3]:
        state, passed = Lifecycle().advance(state, ts)
        name, to = respond(state[0], state[2], event, addr)
        want += passed + [(ts, state[0], name, to)]
        state = (name, ts, to)
    assert len(want) > 1_500_000 and got == want
    assert [tuple(r)[1:4] for r in lifecycle.transitions(log).filter("channel = 'd'").orderBy("ts_ns").collect()] == [
        (0, "none", "wait_status_series"), (5 * SECOND, "wait_status_series", "init"), (year, "init", "wait_status_series")
    ]


def test_null_arrays_pass_a_fold_as_they_are(spark):
    """Null, empty and filled arrays come back; none is null on its way to Python, where a null costs a pass over the batch."""
    rows = [("a", i, i, [None, [], [i, None]][i % 3], None) for i in range(30)]
    df = spark.createDataFrame(rows, "series string, ts_ns long, seq long, some array<long>, never array<decimal(20,0)>")
    for policy in (SlicePolicy(), SlicePolicy(max_rows=7)):
        folded = fold(df, ["series"], K.PartitionRoll(5, 10, 1), policy=policy)
        assert folded.columns == [*df.columns, "ts_msp", "msp_bump", "late"]
        assert folded.select(df.columns).orderBy("seq").collect() == df.orderBy("seq").collect()
        plan = folded._jdf.queryExecution().analyzed().toString()
        assert "coalesce(some" in plan and "coalesce(never" in plan
