"""Registry collisions, address history in steps, table upkeep and whole ingest jobs."""

import contextlib
import datetime
import io
import struct

import pytest
from pyspark.sql import functions as F

from seriesmill.operators import addresses, layout, quality, registry
from seriesmill.operators.kernels import IntervalGate
from seriesmill.operators.slicing import SlicePolicy
from seriesmill.plans import ingest
from seriesmill.schemas import CA_FRAME, DAY, HOUR, REGISTRY, SECOND
from seriesmill.sinks import tables
from seriesmill.sources import archive


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def keys(spark, n):
    return spark.createDataFrame([("lab", f"C{i}", 9, []) for i in range(n)], "backend string, channel string, scalar_type int, shape_dims array<int>")


def test_taken_ids_go_to_the_next_salt(spark):
    empty = spark.createDataFrame([], REGISTRY)
    first = {r["channel"]: r["series"] for r in registry.assign_ids(keys(spark, 20), empty).collect()}
    assert len(set(first.values())) == 20
    taken = spark.createDataFrame([(first["C3"], "lab", "other", 9, [], 0), (first["C4"], "lab", "more", 9, [], 0)], REGISTRY)
    again = {r["channel"]: r["series"] for r in registry.assign_ids(keys(spark, 20), taken).collect()}
    assert {c for c in first if first[c] != again[c]} == {"C3", "C4"}
    assert len(set(again.values()) | {first["C3"], first["C4"]}) == 22


def test_ids_are_stable_and_new_flags_right(spark):
    empty = spark.createDataFrame([], REGISTRY)
    answered, created = registry.get_or_create(keys(spark, 5).unionByName(keys(spark, 5)), empty)
    assert answered.filter("is_new").count() == 10 and created.count() == 5
    answered, more = registry.get_or_create(keys(spark, 8), created)
    assert answered.filter("is_new").count() == 3 and more.count() == 3
    grown = registry.append_absent(created, more.unionByName(created))
    assert grown.count() == 8 and grown.select("series").distinct().count() == 8


def history_rule(log):
    """The history by the rules of one update at a time."""
    rows = []
    for channel, addr, response, t in log:
        mine = [r for r in rows if r["channel"] == channel and not r["archived"]]
        if mine and mine[0]["addr"] == addr:
            mine[0] |= {"tsmod": t, "responseaddr": response}
            continue
        for r in mine:
            r["archived"] = 1
        rows.append({"channel": channel, "addr": addr, "responseaddr": response, "tscreate": t, "tsmod": t, "archived": 0})
    return sorted((r["channel"], r["tscreate"], r["addr"], r["responseaddr"], r["tsmod"], r["archived"]) for r in rows)


@pytest.mark.parametrize("policy", [SlicePolicy(), SlicePolicy(max_rows=12)], ids=["plain", "sliced"])
def test_history_in_three_batches(spark, policy):
    import random

    rng = random.Random(5)
    log = [(rng.choice("aab"), rng.choice([None, "x", "x", "y"]), f"r{t}", t) for t in range(120)]
    rows = [("lab", c, a, r, t, t) for c, a, r, t in log]
    schema = "facility string, channel string, addr string, responseaddr string, tsmod long, seq long"
    current = addresses.address_history(spark.createDataFrame(rows[:40], schema), policy=policy)
    for part in (rows[40:80], rows[80:]):
        changed = addresses.extend_history(current, spark.createDataFrame(part, schema), policy=policy)
        kept = current.join(changed.select("facility", "channel", "run"), ["facility", "channel", "run"], "left_anti")
        current = kept.unionByName(changed).checkpoint()
    got = sorted(tuple(r) for r in current.select("channel", "tscreate", "addr", "responseaddr", "tsmod", "archived").collect())
    want = history_rule(log)
    assert got == want


def test_filters_with_odd_input(spark):
    names = spark.createDataFrame([("A1",), ("B1",), ("A2",)], "channel string")
    assert quality.find_channels(names, "(").count() == 0
    assert quality.include_channels(names, "A1", None).count() == 3
    assert [r[0] for r in quality.include_channels(names, "A1", "A").collect()] == ["A1", "B1"]
    found = spark.createDataFrame([("g", None), (None, "g"), (None, None), ("x", "y")], "response_addr string, addr string")
    gateways = spark.createDataFrame([("g",)], "gateway string")
    assert addresses.drop_gateways(found, gateways).count() == 2


T0 = 1_700_000_000 * SECOND


def events(spark, n=100):
    return spark.range(n).select(
        (F.col("id") % 3).alias("series"),
        (F.col("id") * HOUR + T0).alias("ts_ns"),
        F.col("id").alias("seq"),
        F.col("id").alias("pulse"),
        F.lit("I32").alias("scalar_type"),
        F.array().cast("array<int>").alias("shape_dims"),
        F.col("id").cast("double").alias("value"),
    )


def test_repeated_batch_replaces_itself(spark, tmp_path):
    laid_out = layout.lay_out(events(spark))
    for _ in range(2):
        tables.write_events(laid_out, str(tmp_path), 3)
    stored = tables.read(spark, str(tmp_path), "events_scalar")
    assert stored.count() == 100 and stored.select("batch").distinct().head()[0] == 3
    assert stored.filter("ivalue = seq").count() == 100
    index = tables.read(spark, str(tmp_path), "ts_msp")
    assert index.count() == laid_out.filter("msp_bump").count()


def test_range_read_takes_the_last_write_and_prunes_days(spark, tmp_path):
    root = str(tmp_path)
    rows = layout.lay_out(events(spark))
    tables.write_events(rows, root, 0)
    tables.write_events(rows.withColumn("value", F.col("value") + 1000), root, 1)
    known = spark.createDataFrame([(1, "lab", "C", 6, [], 0)], REGISTRY)
    found = archive.read_range(spark, root, known, "lab", "C", T0 + 10 * HOUR, T0 + 20 * HOUR, span_ns=HOUR)
    assert sorted((r["seq"], r["ivalue"]) for r in found.collect()) == [(i, i + 1000) for i in (10, 13, 16, 19)]
    assert "date" in plan_of(found).split("PartitionFilters: [", 1)[1].split("]")[0]


def test_managed_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS plant")
    assert tables.ensure_table(spark, "receive_interval", "plant")
    assert not tables.ensure_table(spark, "receive_interval", "plant")
    assert tables.check_readable(spark, "receive_interval", "plant")
    assert not tables.check_readable(spark, "no_such_table", "plant")
    spark.sql("DROP TABLE IF EXISTS plant.muted")
    spark.sql("CREATE TABLE plant.muted (part INT, series BIGINT, date DATE) USING parquet PARTITIONED BY (date)")
    tables.ensure_table(spark, "muted", "plant")
    assert {"ts_ns", "ema", "emd"} <= {c.name for c in spark.catalog.listColumns("plant.muted")}
    rows = spark.range(10).select(
        F.lit(0).alias("part"), F.col("id").alias("series"), F.col("id").alias("ts_ns"), F.lit(0.0).alias("ema"), F.lit(0.0).alias("emd"),
        F.date_add(F.lit(datetime.date(2024, 1, 1)), F.col("id").cast("int")).alias("date"),
    )
    rows.write.insertInto("plant.receive_interval")
    assert tables.drop_expired(spark, "receive_interval", "2024-01-04", "plant") == 3
    assert spark.table("plant.receive_interval").count() == 7


def test_retention_bound_reaches_the_scan(spark, tmp_path):
    events(spark).withColumn("written_at", F.col("ts_ns")).write.parquet(str(tmp_path / "e"))
    rows = layout.unexpired(spark.read.parquet(str(tmp_path / "e")), T0 + 2 * DAY, "scalar")
    assert rows.count() == 75
    assert "PushedFilters: [IsNotNull(written_at), GreaterThan(written_at" in plan_of(rows)


def test_device_frames_to_archive(spark, tmp_path):
    frames = []
    for i in range(240):
        head = struct.pack(">HHII", 0, 0, 1_000_000_000 + i * 30, 0)
        frames.append((i, i * 30 * SECOND, 1, 20, 1, 1, i % 2, bytearray(head + b"\0" * 4 + struct.pack(">d", float(i)))))
    frames.append((240, 0, 1, 6, 1, 1, 0, bytearray(b"")))
    subs = spark.createDataFrame([(0, "A"), (1, "B")], "subid long, channel string")
    root = str(tmp_path)
    done = ingest.ingest_device_events(
        spark.createDataFrame(frames, CA_FRAME), subs, ingest.empty_registry(spark), "lab", root, 0, 600 * SECOND, bin_count=10
    )
    stored = tables.read(spark, root, "events_scalar")
    assert stored.count() == 240 and done.created.count() == 2
    assert [tuple(r) for r in done.rejected.collect()] == [(240, "not a time type")]
    patches = tables.read(spark, root, "binned_scalar_f32").collect()
    assert patches and all(len(p["counts"]) == 10 and sum(p["counts"]) == 10 for p in patches)


def test_search_results_to_history(spark):
    asked = spark.createDataFrame([("A", 0, 0), ("B", 0, 1), ("C", 0, 2), ("A", 10 * SECOND, 3)], "channel string, ts_ns long, seq long")
    answers = spark.createDataFrame(
        [("A", SECOND // 10, 0, "i1", "i1"), ("A", SECOND // 5, 1, "i9", "i9"), ("B", SECOND // 2, 2, "gw", "i2"), ("A", 10 * SECOND + 5, 3, "i3", "i3")],
        "channel string, ts_ns long, seq long, response_addr string, addr string",
    )
    gateways = spark.createDataFrame([("gw",)], "gateway string")
    none = addresses.address_history(
        spark.createDataFrame([], "facility string, channel string, addr string, responseaddr string, tsmod long, seq long")
    )
    runs = ingest.update_addresses(asked, answers, gateways, none, "lab")
    got = sorted((r["channel"], r["addr"] or "", r["archived"]) for r in runs.collect())
    assert got == [("A", "i1", 1), ("A", "i3", 0), ("C", "", 0)]
    assert {r["channel"]: r["duplicates"] for r in addresses.duplicate_answers(asked, answers, ("channel",)).collect()}["A"] == 1


def device_batch(spark, seqs, at):
    frames = []
    for i in seqs:
        head = struct.pack(">HHII", 0, 0, 1_000_000_000 + i * 30, 0)
        frames.append((i, at + i, 1, 20, 1, 1, i % 2, bytearray(head + b"\0" * 4 + struct.pack(">d", float(i)))))
    return spark.createDataFrame(frames, CA_FRAME)


def test_two_ingests_keep_both_batches_and_make_the_patches_of_one(spark, tmp_path):
    subs = spark.createDataFrame([(0, "A"), (1, "B")], "subid long, channel string")
    gate = IntervalGate(0, ts="recv_ts_ns")

    def run(root, parts):
        known = ingest.empty_registry(spark)
        for batch, seqs in enumerate(parts):
            done = ingest.ingest_device_events(device_batch(spark, seqs, batch * DAY), subs, known, "lab", root, batch, 600 * SECOND, gate, bin_count=10)
            known = known.unionByName(done.created).checkpoint()
        stored = tables.read(spark, root, "events_scalar")
        indexed = tables.read(spark, root, "ts_msp")
        assert stored.join(indexed, ["series", "ts_msp"], "left_anti").count() == 0
        patches = ingest.current_patches(spark, root).drop("batch").collect()
        return stored.count(), sorted((tuple(map(str, r)) for r in patches))

    one = run(str(tmp_path / "one"), [range(240)])
    two = run(str(tmp_path / "two"), [[*range(0, 100), *range(150, 240)], range(100, 150)])
    assert one[0] == two[0] == 240
    assert one[1] == two[1] and one[1]


def test_patches_read_the_days_and_series_they_touch(spark, tmp_path):
    root = str(tmp_path)
    tables.write_events(layout.lay_out(events(spark)), root, 0)
    every = tables.read(spark, root, "events_scalar")
    patch, first = 10 * HOUR, T0 // (10 * HOUR) + 6
    touched = spark.createDataFrame([(1, first, first + 1)], "series long, _first long, _last long")
    found = ingest.events_since(every, touched, patch, HOUR)
    asked = every.filter(f"series = 1 and ts_ns >= {first * patch - HOUR}")
    assert sorted(found.select("series", "ts_ns", "seq").collect()) == sorted(asked.select("series", "ts_ns", "seq").collect())
    plan = plan_of(found)
    assert "date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert "GreaterThanOrEqual(ts_ns" in plan and "GreaterThanOrEqual(series,1)" in plan
    assert 0 < found.count() < every.filter("series = 1").count()
    assert ingest.events_since(every, touched.filter("series > 1"), patch, HOUR).count() == 0


def test_status_files_by_time_do_not_overlap(spark, tmp_path):
    """Each file of a day holds a range of times of its own, in order, and a range read prunes days and row groups."""
    root, hour = str(tmp_path), 3_600_000_000_000
    rows = spark.range(4000).select((F.col("id") % 97).alias("series"), (F.col("id") * 40_000_000_000).alias("ts_ns"), (F.col("id") % 6).cast("int").alias("kind"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_channel_status(tables.status_rows(rows), root, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = tables.read(spark, root, "channel_status_by_time")
    spans = stored.groupBy(F.input_file_name().alias("f")).agg(F.min(F.struct("ts_msp", "ts_lsp")).alias("lo"), F.max(F.struct("ts_msp", "ts_lsp")).alias("hi")).orderBy("lo").collect()
    assert len(spans) > 4 and all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))
    found = archive.status_range(spark, root, 5 * hour, 7 * hour)
    plan = found._jdf.queryExecution().toString()
    assert found.count() == 181 and "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(ts_msp" in plan
    assert tables.read(spark, root, "channel_status").count() == 4000
