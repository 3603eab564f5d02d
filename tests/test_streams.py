"""Streams in several micro-batches against the table operators."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import bins, layout, lifecycle
from seriesmill.operators.kernels import GridChange, IntervalGate, PartitionRoll
from seriesmill.schemas import EVENTS, LIFECYCLE, LONG, MINUTE, SECOND, struct
from seriesmill.sinks import tables
from seriesmill.operators.fold import exit_states, fold
from seriesmill.operators.slicing import SlicePolicy
from seriesmill.streaming import folds, jobs, sliced

T0 = 1_700_000_000 * SECOND


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    """Events in four files by time; within a file the order is random."""
    rng = random.Random(2)
    rows, t = [], T0
    for i in range(800):
        t += rng.choice([1, 5, 40]) * SECOND
        rows.append((rng.randrange(3), t, i, i, "F64", [], rng.random()))
    path = str(tmp_path_factory.mktemp("events"))
    for k in range(4):
        part = rows[k * 200 : (k + 1) * 200]
        rng.shuffle(part)
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(path)
    return path


def test_ingest_in_micro_batches(spark, event_files, tmp_path):
    root = str(tmp_path)
    kernels = dict(gate=IntervalGate(60 * SECOND), roll=PartitionRoll(9, 10 * MINUTE), grid=GridChange(SECOND, 300))
    stream = jobs.follow(spark, event_files, EVENTS, files_per_trigger=1)
    jobs.ingest(stream, root, f"{root}/checkpoint", **kernels).awaitTermination()
    stored = tables.read(spark, root, "events_scalar")
    assert stored.select("batch").distinct().count() == 4
    whole = layout.lay_out(spark.read.schema(EVENTS).parquet(event_files), **kernels)
    columns = ["series", "seq", "ts_msp", "ts_lsp", "msp_bump", "ts_msp_grid", "fvalue"]
    want = whole.filter("admitted").withColumn("fvalue", F.col("value")).select(columns)
    assert stored.select(columns).exceptAll(want).count() == 0 and stored.count() == want.count()
    reports = tables.read(spark, root, "receive_interval").count()
    assert reports == whole.filter("report").count() > 0
    index = tables.read(spark, root, "ts_msp").select("series", "ts_msp").distinct()
    assert index.count() == whole.filter("msp_bump").select("series", "ts_msp").distinct().count()


def test_bins_in_micro_batches(spark, event_files, tmp_path):
    stream = jobs.follow(spark, event_files, EVENTS, files_per_trigger=1)
    out = folds.bin_stream(stream, MINUTE, "2 minutes", max_carry_ns=5 * MINUTE)
    jobs.to_files(out, f"{tmp_path}/bins", f"{tmp_path}/checkpoint").awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{tmp_path}/bins")
    whole = spark.read.schema(EVENTS).parquet(event_files)
    mark = (whole.agg(F.max("ts_ns")).head()[0] // 1_000_000 - 120_000) * 1_000_000
    want = {(r["series"], r["bin"]): r for r in bins.time_weighted_bins(whole, MINUTE, max_carry_ns=5 * MINUTE).collect() if (r["bin"] + 1) * MINUTE <= mark}
    rows = got.collect()
    have = {(r["series"], r["bin"]): r for r in rows}
    assert len(rows) == len(have) and set(want) <= set(have)
    assert all(have[k]["count"] == 0 for k in set(have) - set(want))
    for k, w in want.items():
        assert (have[k]["count"], have[k]["min"], have[k]["max"]) == (w["count"], w["min"], w["max"])
        assert have[k]["avg"] == pytest.approx(w["avg"], rel=1e-9)


class Kept(dict):
    """A state map without a stream."""

    getValue, updateValue, removeKey, iterator = dict.get, dict.__setitem__, dict.__delitem__, dict.items


class Handle:
    def getMapState(self, *_):
        return Kept()


def test_pending_rows_are_merged_block_by_block():
    """Rows come back in order and in parts that do not grow with their number; later ones stay."""
    rng, most = random.Random(5), 0

    class Small(folds.PendingRows):
        RUN, BLOCK = 400, 16

    pending, want = Small(Handle()), []
    assert pending.first() is None and list(pending.take(10)) == []
    for mark in (0, 300, 310, 900, 2000):
        new = [(rng.randrange(min(mark, 1400), 1500), rng.choice([folds.LOWEST, rng.randrange(50)]), float(rng.randrange(3))) for _ in range(1500)]
        pending.add(pd.DataFrame(new[i : i + 50], columns=["ts_ns", "seq", "value"]) for i in range(0, 1500, 50))
        want = sorted(want + new)
        parts = list(pending.take(mark))
        most = max([most, *map(len, parts)])
        got = [tuple(r) for p in parts for r in p.tolist()]
        assert got == [r for r in want if r[0] < mark]
        want = want[len(got) :]
        assert pending.first() == (want[0][0] if want else None)
    assert 0 < most <= 16 * 20 and not pending.runs and not pending.blocks


def test_ingest_of_many_series_in_a_bucket(spark, tmp_path):
    """A bucket holds series of any id, null among them, and goes on with each one's state in the next micro-batch."""
    rng = random.Random(8)
    names = [None, 0, 1, *range(2**60, 2**60 + 40)]
    rows = [(rng.choice(names), T0 + i * SECOND, i, i, "F64", [], rng.random()) for i in range(3000)]
    for part in (rows[:1500], rows[1500:]):
        rng.shuffle(part)
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    kernels = dict(gate=IntervalGate(60 * SECOND), roll=PartitionRoll(9, 10 * MINUTE), grid=GridChange(SECOND, 300))
    whole = layout.lay_out(spark.createDataFrame(rows, EVENTS), **kernels)
    columns = ["series", "seq", "ts_msp", "ts_lsp", "msp_bump", "ts_msp_grid", "fvalue"]
    want = whole.filter("admitted").withColumn("fvalue", F.col("value")).select(columns)
    root = f"{tmp_path}/out"
    stream = jobs.follow(spark, f"{tmp_path}/in", EVENTS, files_per_trigger=1)
    jobs.ingest(stream, root, f"{root}/checkpoint", **kernels, buckets=2).awaitTermination()
    stored = tables.read(spark, root, "events_scalar")
    assert stored.select("batch").distinct().count() == 2 and stored.filter("series is null").count() > 0
    assert stored.select(columns).exceptAll(want).count() == 0 and stored.count() == want.count()
    assert tables.read(spark, root, "receive_interval").count() == whole.filter("report").count() > 0


TIGHT = SlicePolicy(max_rows=100)


@pytest.fixture(scope="module")
def hot_files(spark, event_files, tmp_path_factory):
    """The same events with nine tenths of them in one series, and a null series."""
    path = str(tmp_path_factory.mktemp("hot"))
    series = F.when(F.col("seq") % 10 > 0, 7).when(F.col("seq") % 20 > 0, F.col("series")).cast("long")
    for k in range(4):
        part = spark.read.schema(EVENTS).parquet(event_files).filter(F.col("seq").between(k * 200, k * 200 + 199))
        part.withColumn("series", series).coalesce(1).write.mode("append").parquet(path)
    return path


def test_folds_go_on_from_given_states(spark, hot_files):
    whole = spark.read.schema(EVENTS).parquet(hot_files)
    for kernel, policies in ((IntervalGate(60 * SECOND), (TIGHT,)), (PartitionRoll(9, 10 * MINUTE), (SlicePolicy(), TIGHT))):
        want = fold(whole, ["series"], kernel)
        for policy in policies:
            early = fold(whole.filter("seq < 300"), ["series"], kernel, policy=policy, exits=True)
            late = fold(whole.filter("seq >= 300"), ["series"], kernel, policy=policy, entry=exit_states(early, ["series"]))
            got = early.select(want.columns).union(late.select(want.columns))
            assert got.exceptAll(want).count() == 0 and got.count() == 800


def test_hot_series_ingest_in_micro_batches(spark, hot_files, tmp_path):
    root = str(tmp_path)
    kernels = dict(gate=IntervalGate(60 * SECOND), roll=PartitionRoll(9, 10 * MINUTE), grid=GridChange(SECOND, 300))
    stream = jobs.follow(spark, hot_files, EVENTS, files_per_trigger=1)
    sliced.ingest_batches(stream, root, f"{root}/checkpoint", **kernels, policy=TIGHT).awaitTermination()
    stored = tables.read(spark, root, "events_scalar")
    assert stored.select("batch").distinct().count() == 4
    whole = layout.lay_out(spark.read.schema(EVENTS).parquet(hot_files), **kernels)
    columns = ["series", "seq", "ts_msp", "ts_lsp", "msp_bump", "ts_msp_grid", "fvalue"]
    want = whole.filter("admitted").withColumn("fvalue", F.col("value")).select(columns)
    assert stored.select(columns).exceptAll(want).count() == 0 and stored.count() == want.count()
    assert tables.read(spark, root, "receive_interval").count() == whole.filter("report").count() > 0


def test_hot_series_bins_and_late_rows(spark, hot_files, tmp_path):
    """Closed bins equal the table form; a row behind the settled time is set aside."""
    files, root = f"{tmp_path}/in", f"{tmp_path}/out"
    whole = spark.read.schema(EVENTS).parquet(hot_files)
    for k in range(4):
        whole.filter(F.col("seq").between(k * 200, k * 200 + 199)).coalesce(1).write.mode("append").parquet(files)
    spark.createDataFrame([(7, T0, -1, -1, "F64", [], 5.0), (7, None, -2, -2, "F64", [], 5.0)], EVENTS).coalesce(1).write.mode("append").parquet(files)
    stream = jobs.follow(spark, files, EVENTS, files_per_trigger=1)
    sliced.bin_batches(stream, root, f"{root}/checkpoint", MINUTE, 2 * MINUTE, max_carry_ns=5 * MINUTE, policy=TIGHT).awaitTermination()
    assert [r["seq"] for r in spark.read.parquet(f"{root}/late").collect()] == [-1]
    rows = bins.expand_runs(spark.read.parquet(f"{root}/bins"), MINUTE).collect()
    have = {(r["series"], r["bin"]): r for r in rows}
    events = whole.collect()
    mark = max(e["ts_ns"] for e in events) - 2 * MINUTE
    held, counts = {}, {}  # (value, weight) of every bin by each event of its series, and the events in it
    for series in {e["series"] for e in events}:
        own = sorted((e["ts_ns"], e["seq"], e["value"]) for e in events if e["series"] == series and e["ts_ns"] < mark)
        for (ts, _, value), after in zip(own, [*own[1:], (mark,)]):
            counts[series, ts // MINUTE] = counts.get((series, ts // MINUTE), 0) + 1
            until = min(after[0], ts + 5 * MINUTE)
            for b in range(ts // MINUTE, max(ts, until - 1) // MINUTE + 1):
                held.setdefault((series, b), []).append((value, min(until, (b + 1) * MINUTE) - max(ts, b * MINUTE)))
    want = {k for k in held if (k[1] + 1) * MINUTE <= mark}
    assert len(rows) == len(have) and set(have) == want and {None, 7} <= {k[0] for k in want}
    for k in want:
        values = [v for v, _ in held[k]]
        assert (have[k]["count"], have[k]["min"], have[k]["max"]) == (counts.get(k, 0), min(values), max(values))
        assert have[k]["avg"] == pytest.approx(sum(v * w for v, w in held[k]) / sum(w for _, w in held[k]), rel=1e-9)


def test_a_repeated_batch_replaces_its_first_attempt(spark, hot_files, tmp_path, monkeypatch):
    """A batch that fails after it has written state and output is run again by the restarted query."""
    root, tried = str(tmp_path), []
    stream = jobs.follow(spark, hot_files, EVENTS, files_per_trigger=1)
    forget = sliced.Handover.forget

    def fail_once(state, *names):
        if state.batch == 2 and not tried:
            tried.append(state.batch)
            raise RuntimeError("lost")
        forget(state, *names)

    monkeypatch.setattr(sliced.Handover, "forget", fail_once)
    run = lambda: sliced.silence_batches(stream, root, f"{root}/checkpoint", "series", 30 * SECOND, 10 * SECOND, policy=TIGHT).awaitTermination()
    with pytest.raises(Exception):
        run()
    run()
    whole = spark.read.schema(EVENTS).parquet(hot_files)
    now = whole.agg(F.max("ts_ns")).head()[0]
    want = lifecycle.silences(whole, now, ("series",), 30 * SECOND, 10 * SECOND)
    got = spark.read.parquet(f"{root}/alarms").select(want.columns)
    assert tried and got.exceptAll(want).count() == 0 and got.count() == want.count() > 10


LOG = [
    ("a", 0, "add", None),
    ("a", 1, "series", None),
    ("a", 10, "found", "i1"),
    ("a", 50, "connection_done", "i9"),
    ("a", 60, "connection_done", "i1"),
    ("b", 0, "add", None),
    ("b", 4, "series", None),
    ("b", 5, "found", "i2"),
    ("b", 20, "not_found", None),
    ("c", 0, "add", None),
    ("c", 1, "series", None),
    ("c", 100, "found", "i3"),
    ("a", 101, "remove", None),
]


def log_frame(spark):
    rows = [(c, T0 + t * SECOND, e, a, i) for i, (c, t, e, a) in enumerate(LOG)]
    return spark.createDataFrame(rows, struct(**{f.name: f.dataType for f in LIFECYCLE.fields}, seq=LONG))


def seconds(rows):
    return sorted(((r["channel"], (r["ts_ns"] - T0) // SECOND, r["before"], r["after"]) for r in rows), key=lambda r: (r[0], r[1]))


def test_lifecycle_script(spark):
    changes = lifecycle.transitions(lifecycle.with_end(log_frame(spark), T0 + 110 * SECOND))
    got = seconds(changes.collect())
    assert [r for r in got if r[0] == "a"] == [
        ("a", 0, "none", "wait_status_series"),
        ("a", 1, "wait_status_series", "unknown_address"),
        ("a", 3, "unknown_address", "search_pending"),
        ("a", 10, "search_pending", "assigned"),
        ("a", 60, "assigned", "init"),
        ("a", 101, "init", "to_remove"),
    ]
    assert [r[1:] for r in got if r[0] == "b"] == [
        (0, "none", "wait_status_series"),
        (4, "wait_status_series", "unknown_address"),
        (6, "unknown_address", "search_pending"),
        (20, "search_pending", "no_address"),
        (40, "no_address", "unknown_address"),
        (42, "unknown_address", "search_pending"),
        (72, "search_pending", "no_address"),
        (92, "no_address", "unknown_address"),
        (94, "unknown_address", "search_pending"),
    ]
    assert [r[1:] for r in got if r[0] == "c"][2:] == [
        (3, "unknown_address", "search_pending"),
        (33, "search_pending", "no_address"),
        (53, "no_address", "unknown_address"),
        (55, "unknown_address", "search_pending"),
        (85, "search_pending", "no_address"),
        (105, "no_address", "unknown_address"),
        (107, "unknown_address", "search_pending"),
    ]
    items = lifecycle.channel_status_items(log_frame(spark), changes).collect()
    assert [(r["channel"], r["kind"]) for r in items] == [("a", 24)]
    kinds = lifecycle.connection_status_items(log_frame(spark)).collect()
    assert sorted((r["addr"], r["kind"]) for r in kinds) == [("i1", 6), ("i9", 6)]


def test_lifecycle_stream_equals_table(spark, tmp_path):
    log = log_frame(spark)
    for lo, hi in ((0, 15), (15, 55), (55, 999)):
        part = log.filter(F.col("ts_ns").between(T0 + lo * SECOND, T0 + hi * SECOND - 1))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.follow(spark, f"{tmp_path}/in", log.schema, files_per_trigger=1)
    out = folds.lifecycle_stream(stream)
    jobs.to_files(out, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = seconds(spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect())
    want = seconds(lifecycle.transitions(lifecycle.with_end(log, T0 + 101 * SECOND)).collect())
    assert got == want


def test_silences_script(spark, tmp_path):
    rows = [("x", T0, 0), ("x", T0 + 25 * SECOND, 1), ("x", T0 + 30 * SECOND, 2), ("y", T0 + 70 * SECOND, 3)]
    log = spark.createDataFrame(rows, "addr string, ts_ns long, seq long")
    alarms = lifecycle.silences(log, T0 + 71 * SECOND).collect()
    want = sorted([("x", "shutdown", 20), ("x", "shutdown", 50), ("x", "critical", 60)])
    assert sorted((r["addr"], r["alarm"], (r["alarm_ts_ns"] - T0) // SECOND) for r in alarms) == want
    log.coalesce(1).write.parquet(f"{tmp_path}/in")
    out = folds.silence_stream(jobs.follow(spark, f"{tmp_path}/in", log.schema))
    jobs.to_files(out, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    live = spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect()
    assert sorted((r["addr"], r["alarm"], (r["alarm_ts_ns"] - T0) // SECOND) for r in live) == want


def test_sampling_of_a_stream_is_by_hash(spark, event_files):
    from seriesmill.operators.sampling import sample_fraction, sample_hashed

    stream = jobs.follow(spark, event_files, EVENTS)
    assert sample_hashed(stream, 100, ("series",)).isStreaming
    with pytest.raises(ValueError):
        sample_fraction(stream, 100, ("series",))
