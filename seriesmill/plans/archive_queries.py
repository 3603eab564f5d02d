"""Tables written and read back, and streams that must equal their table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.operators import bins, layout, lifecycle, registry, statistics
from seriesmill.operators.kernels import GridChange, IntervalGate, PartitionRoll
from seriesmill.operators.slicing import SlicePolicy, number_rows
from seriesmill.plans import ingest
from seriesmill.plans.driver_tables import as_events, events, messages, nanos, scratch, table, waves
from seriesmill.plans.ordered_queries import GATE_SQL, GRID_SQL, IVL, REPORT, ROLL_SQL, SPACING, UNIT, bins_sql, gated
from seriesmill.plans.registered import query, rounded, user_events
from seriesmill.plans.registry_queries import MATCH_SQL, no_registry, requests
from seriesmill.schemas import DAY, HOUR, REGISTRY
from seriesmill.session import ROCKSDB, small_table
from seriesmill.sinks import archive_files, tables
from seriesmill.sources import archive, captures
from seriesmill.streaming import folds, jobs, sliced


def _laid_out(spark, sf_dir):
    return layout.lay_out(events(spark, sf_dir), PartitionRoll(5, DAY, HOUR), GridChange(UNIT, SPACING))


@query(
    "k1_scalar_sink",
    ROLL_SQL + " SELECT series, seq, msp AS ts_msp, f.ts_ns - msp AS ts_lsp, value AS fvalue, 'F64' AS scalar_type FROM f JOIN ev USING (series, seq)",
)
def scalar_sink(spark, sf_dir):
    root = scratch(spark)
    tables.write_events(_laid_out(spark, sf_dir), root, 0)
    return tables.read(spark, root, "events_scalar").select("series", "seq", "ts_msp", "ts_lsp", "fvalue", "scalar_type")


@query(
    "k2_array_sink",
    """SELECT label::BIGINT AS series, vec_id AS seq, len(embedding)::INTEGER AS n, round(list_sum(embedding::DOUBLE[]), 6) + 0.0 AS total FROM embeddings""",
)
def array_sink(spark, sf_dir):
    root = scratch(spark)
    tables.write_events(layout.roll_partitions(waves(spark, sf_dir)), root, 0)
    total = F.aggregate("fvalues", F.lit(0.0), lambda a, x: a + x)
    back = tables.read(spark, root, "events_array")
    return back.select("series", "seq", F.size("fvalues").alias("n"), rounded(total, 6, "total"))


@query(
    "k2_array_elements",
    """WITH e AS (SELECT label::BIGINT AS series, vec_id AS seq, unnest(range(len(embedding)))::INTEGER AS pos, embedding FROM embeddings)
SELECT series, seq, pos, 'F32' AS scalar_type, round(embedding[pos + 1]::DOUBLE, 6) + 0.0 AS fvalue, NULL::BOOLEAN AS bvalue FROM e
UNION ALL SELECT series, seq, pos, 'BOOL', NULL, embedding[pos + 1] > 0 FROM e""",
)
def array_elements(spark, sf_dir):
    """Every element of the stored arrays: numbers, and their signs as boolean arrays."""
    root = scratch(spark)
    numbers = waves(spark, sf_dir).withColumn("floats", F.col("fvalues")).withColumn("ints", F.lit(None).cast("array<bigint>"))
    signs = numbers.withColumn("scalar_type", F.lit("BOOL")).withColumn("ints", F.transform("fvalues", lambda x: (x > 0).cast("long"))).withColumn("floats", F.lit(None).cast("array<double>"))
    typed = ingest.typed_columns(numbers.unionByName(signs).withColumn("text", F.lit(None).cast("string")))
    tables.write_events(layout.roll_partitions(typed, ("series", "scalar_type")), root, 0)
    back = tables.read(spark, root, "events_array")
    own = back.withColumn("_at", F.explode(F.sequence(F.lit(0), F.element_at("shape_dims", 1) - 1)))
    return own.select("series", "seq", F.col("_at").alias("pos"), "scalar_type", rounded(F.get("fvalues", "_at"), 6, "fvalue"), F.get("bvalues", "_at").alias("bvalue"))


FROM, TO = 1_705_000_000 * 1_000_000_000, 1_705_800_000 * 1_000_000_000
STATUS = f"""SELECT event_id AS seq, user_id AS series, (event_id % 6 + 1)::INTEGER AS kind, epoch_ns(ts) // {HOUR} * {HOUR} AS ts_msp,
 epoch_ns(ts) % {HOUR} AS ts_lsp, '10.0.0.' || user_id % 250 || ':5064' AS addr FROM events"""


def status_items(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    addr = F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string"), F.lit(":5064"))
    return rows.select(
        F.col("user_id").alias("series"), (F.col("event_id") % 6 + 1).cast("int").alias("kind"), nanos("ts").alias("ts_ns"), addr.alias("addr")
    )


@query("k5_connection_status_log", f"SELECT addr, ts_msp, ts_lsp, kind FROM ({STATUS})")
def connection_status_log(spark, sf_dir):
    root = scratch(spark)
    tables.write(tables.status_rows(status_items(spark, sf_dir)), root, "connection_status", 0)
    return tables.read(spark, root, "connection_status").select("addr", "ts_msp", "ts_lsp", "kind")


@query("k6_channel_status_log", f"SELECT series, ts_msp, ts_lsp, kind FROM ({STATUS})")
def channel_status_log(spark, sf_dir):
    root = scratch(spark)
    tables.write_channel_status(tables.status_rows(status_items(spark, sf_dir)), root, 0)
    return tables.read(spark, root, "channel_status").select("series", "ts_msp", "ts_lsp", "kind")


@query(
    "k6_status_by_time",
    f"""WITH s AS ({STATUS}), t AS (SELECT ts_msp + ts_lsp AS ts_ns, series, kind FROM s)
SELECT series, ts_ns, kind, row_number() OVER (ORDER BY ts_ns, series, kind) - 1 AS position FROM t WHERE ts_ns BETWEEN {FROM} AND {TO}""",
)
def status_by_time(spark, sf_dir):
    """The log of all series over a range of time, in order, from the layout by time."""
    root = scratch(spark)
    tables.write_channel_status(tables.status_rows(status_items(spark, sf_dir)), root, 0)
    found = archive.status_range(spark, root, FROM, TO)
    return number_rows(found, ["ts_ns", "series", "kind"], "position").select("series", "ts_ns", "kind", "position")


@query(
    "k7_channel_pings",
    """SELECT (user_id & 255)::INTEGER AS part, epoch_ns(ts) // 60000000000 * 60 AS minute, user_id AS series, 0 AS evsize
FROM events GROUP BY ALL""",
)
def channel_ping_sink(spark, sf_dir):
    root = scratch(spark)
    tables.write(tables.ping_rows(statistics.channel_pings(events(spark, sf_dir))), root, "channel_ping", 0)
    return tables.read(spark, root, "channel_ping").select("part", "minute", "series", "evsize")


REPORT_SQL = GATE_SQL + """ SELECT (series & 255)::INTEGER AS part, series, ts_ns, round(ema, 4) + 0.0 AS ema, round(sqrt(emv), 4) + 0.0 AS emd
 FROM f WHERE report"""


def _reports(spark, sf_dir, name):
    root = scratch(spark)
    tables.write(tables.with_part(statistics.interval_reports(gated(spark, sf_dir))), root, name, 0)
    return tables.read(spark, root, name).select("part", "series", "ts_ns", rounded("ema", 4), rounded("emd", 4))


@query("k8_muted_sink", REPORT_SQL)
def muted_sink(spark, sf_dir):
    return _reports(spark, sf_dir, "muted")


@query("k9_receive_interval_sink", REPORT_SQL)
def receive_interval_sink(spark, sf_dir):
    return _reports(spark, sf_dir, "receive_interval")


@query(
    "k10_bin_patch_sink",
    bins_sql("user_id", DAY)
    + """, p AS (SELECT *, bin // 4 AS off, count(*) OVER (PARTITION BY series, bin // 4) AS n FROM b)
SELECT series, 86400::BIGINT AS bin_len_sec, off // 1000 AS off_msp, off % 1000 AS off_lsp, sum("count")::BIGINT AS n, max("max"::FLOAT) AS top
FROM p WHERE n = 4 GROUP BY series, off""",
)
def bin_patch_sink(spark, sf_dir):
    root = scratch(spark)
    binned = bins.time_weighted_bins(events(spark, sf_dir), DAY, single_precision=True, max_carry_ns=None)
    tables.write(bins.bin_patches(binned, DAY, 4), root, "binned_scalar_f32", 0)
    n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    back = tables.read(spark, root, "binned_scalar_f32")
    return back.select("series", "bin_len_sec", "off_msp", "off_lsp", n.alias("n"), F.array_max("maxs").alias("top"))


@query(
    "k10_patches_in_batches",
    bins_sql("user_id", DAY)
    + """, p AS (SELECT *, bin // 4 AS off, count(*) OVER (PARTITION BY series, bin // 4) AS n FROM b)
SELECT series, off // 1000 AS off_msp, off % 1000 AS off_lsp, sum("count")::BIGINT AS n, max("max"::FLOAT) AS top, min("min"::FLOAT) AS low,
  round(sum("avg"::FLOAT::DOUBLE), 2) + 0.0 AS avgs FROM p WHERE n = 4 GROUP BY series, off""",
)
def patches_in_batches(spark, sf_dir):
    """Events stored in three batches, every third one in each; the patches are those of one batch."""
    root = scratch(spark)
    for batch in range(3):
        rows = events(spark, sf_dir).filter(F.col("seq") % 3 == batch)
        tables.write_events(layout.roll_partitions(rows), root, batch)
        ingest.update_patches(spark, root, batch, DAY, 4, 60 * DAY)
    total = lambda c, kind: F.aggregate(c, F.lit(0).cast(kind), lambda a, x: a + x)
    back = ingest.current_patches(spark, root)
    return back.select(
        "series", "off_msp", "off_lsp", total("counts", "long").alias("n"), F.array_max("maxs").alias("top"), F.array_min("mins").alias("low"),
        rounded(total("avgs", "double"), 2, "avgs"),
    )


@query(
    "k11_item_routing",
    """WITH i AS (SELECT event_id % 7 AS k, event_id FROM events)
SELECT ['events_scalar', 'connection_status', 'channel_status', 'channel_ping', 'muted', 'receive_interval', 'binned_scalar_f32'][k + 1] AS destination,
 count(*) AS n FROM i GROUP BY k""",
)
def item_routing(spark, sf_dir):
    """A mixed table of items, one seventh of each kind, written to seven tables and counted there."""
    kinds = ["insert", *tables.ROUTES]
    n = F.col("seq")
    items = events(spark, sf_dir).withColumns(
        {
            "item": F.element_at(F.array(*[F.lit(k) for k in kinds]), (n % 7 + 1).cast("int")),
            "ts_msp": F.col("ts_ns") - F.col("ts_ns") % HOUR,
            "ts_lsp": F.col("ts_ns") % HOUR,
            "minute": F.expr("ts_ns div 60000000000 * 60"),
        }
    )
    items = items.withColumn("kind", F.lit(1)).withColumn("addr", F.lit("10.0.0.1:5064"))
    root = scratch(spark)
    tables.route_items(items, root, 0)
    names = ["events_scalar", *[t for t, _ in tables.ROUTES.values()]]
    counts = [tables.read(spark, root, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("destination"), "n") for t in names]
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    return every


@query(
    "k14_key_violations",
    f"""SELECT user_id AS series, epoch_ns(ts) // {DAY} * {DAY} AS ts_msp, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
)
def key_violations(spark, sf_dir):
    rows = events(spark, sf_dir).select("series", (F.col("ts_ns") - F.col("ts_ns") % DAY).alias("ts_msp"))
    return tables.key_violations(rows, "ts_msp")




@query(
    "s12_j5_event_range",
    f"""SELECT event_id AS seq, epoch_ns(ts) AS ts_ns, value AS fvalue FROM events WHERE user_id = 8 AND event_type = 'click'
 AND epoch_ns(ts) BETWEEN {FROM} AND {TO}""",
)
def event_range(spark, sf_dir):
    """Every event stored under the series of its channel, then one channel read back by time range."""
    asked = requests(spark, sf_dir)
    answered, created = registry.get_or_create(asked, no_registry(spark))
    ids = answered.select(F.col("request_id").alias("seq"), F.col("series").alias("_id"))
    rows = events(spark, sf_dir).join(ids, "seq").drop("series").withColumnRenamed("_id", "series")
    root = scratch(spark)
    tables.write_events(layout.roll_partitions(rows), root, 0)
    found = archive.read_range(spark, root, created, "lab", "CH:8:click", FROM, TO, span_ns=HOUR)
    return found.select("seq", "ts_ns", "fvalue")


@query(
    "j5_active_series",
    GRID_SQL + " SELECT DISTINCT series FROM c WHERE grid BETWEEN 473600 AND 473650",
)
def active_series(spark, sf_dir):
    index = layout.grid_index(layout.mark_grid_changes(events(spark, sf_dir), unit=UNIT, spacing=SPACING))
    return archive.active_series(index, 473600, 473650)


GOOD = "event_id % 17 <> 0 AND event_id % 13 <> 0"


@query("s1_capture_source", "SELECT event_id AS msg_id, CASE WHEN event_id % 17 = 0 THEN 1 WHEN event_id % 7 = 0 THEN 8 ELSE 6 END AS frames FROM events")
def capture_source(spark, sf_dir):
    root = scratch(spark)
    messages(spark, sf_dir).write.parquet(root)
    return captures.read_captures(spark, root).select("msg_id", F.size("frames").alias("frames"))


@query(
    "x1_ingest_captures",
    f"""SELECT event_id AS seq, 'F64' AS scalar_type, value AS fvalue, NULL::BIGINT AS ivalue, NULL AS svalue, ts_ns FROM e WHERE {GOOD}
UNION ALL SELECT event_id, 'I32', NULL, event_id, NULL, ts_ns FROM e WHERE {GOOD}
UNION ALL SELECT event_id, 'STRING', NULL, NULL, event_type, ts_ns FROM e WHERE {GOOD} AND event_id % 7 = 0""".replace(
        "SELECT event_id AS seq", "WITH e AS (SELECT *, epoch_ns(ts) AS ts_ns FROM events) SELECT event_id AS seq", 1
    ),
)
def ingest_captured(spark, sf_dir):
    """From captured messages to stored events; two series hold two fifths of the rows each."""
    root = scratch(spark)
    ingest.ingest_captures(messages(spark, sf_dir), no_registry(spark), "lab", root, 0)
    return tables.read(spark, root, "events_scalar").select("seq", "scalar_type", "fvalue", "ivalue", "svalue", "ts_ns")


# Streams over the events file, read to its end.


def stream(spark, sf_dir, by="user_id"):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = table(spark, sf_dir, "events").schema
    return as_events(jobs.follow(spark, sf_dir, schema, pattern="events.parquet"), by)


@query(
    "x1_stream_ingest",
    GATE_SQL + " SELECT series, seq FROM f WHERE admitted",
)
def stream_ingest(spark, sf_dir):
    root = scratch(spark)
    jobs.ingest(
        stream(spark, sf_dir), root, f"{root}/checkpoint",
        gate=IntervalGate(IVL, 0.05, REPORT), roll=PartitionRoll(5, DAY, HOUR), grid=GridChange(UNIT, SPACING),
    ).awaitTermination()
    return tables.read(spark, root, "events_scalar").select("series", "seq")


def late_ingest(spark, sf_dir):
    """Two micro-batches, the second with the events between those of the first; gated by arrival."""
    root = scratch(spark)
    rows = events(spark, sf_dir).withColumn("recv_ts_ns", (F.col("seq") % 2) * 90 * DAY + F.col("ts_ns"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    gate, layout = IntervalGate(0, 0.05, REPORT, "recv_ts_ns"), dict(roll=PartitionRoll(5, DAY, HOUR), grid=GridChange(UNIT, SPACING))
    for half in range(2):
        rows.filter(F.col("seq") % 2 == half).write.mode("append").parquet(f"{root}/in")
        jobs.ingest(jobs.follow(spark, f"{root}/in", rows.schema), f"{root}/out", f"{root}/checkpoint", gate=gate, **layout).awaitTermination()
    return f"{root}/out"


@query("x1_late_events", "SELECT user_id AS series, event_id AS seq, value AS fvalue FROM events")
def late_events(spark, sf_dir):
    return tables.read(spark, late_ingest(spark, sf_dir), "events_scalar").select("series", "seq", "fvalue")


@query(
    "s12_late_range",
    f"SELECT event_id AS seq, epoch_ns(ts) AS ts_ns, value AS fvalue FROM events WHERE user_id = 8 AND epoch_ns(ts) BETWEEN {FROM} AND {TO}",
)
def late_range(spark, sf_dir):
    """One series read back by its partition index, late rows and all."""
    known = small_table(spark, [(8, "lab", "U8", 10, [], 0)], REGISTRY)
    found = archive.read_range(spark, late_ingest(spark, sf_dir), known, "lab", "U8", FROM, TO, span_ns=DAY)
    return found.select("seq", "ts_ns", "fvalue")


@query(
    "x2_stream_bins",
    bins_sql("event_type", HOUR, f"least(coalesce(nx, ts_ns), ts_ns + {2 * DAY})")
    + """ SELECT series, bin, "count", "min", "max", round("avg", 6) + 0.0 AS "avg" FROM b
WHERE (bin + 1) * 3600000 <= (SELECT max(epoch_ns(ts)) // 1000000 - 86400000 FROM events)""",
)
def stream_bins(spark, sf_dir):
    """Bins that the final watermark, a day behind the last event, has passed."""
    root = scratch(spark)
    binned = folds.bin_stream(stream(spark, sf_dir, "event_type"), HOUR, "1 day", max_carry_ns=2 * DAY)
    jobs.to_files(binned, f"{root}/bins", f"{root}/checkpoint").awaitTermination()
    back = spark.read.schema(binned.schema).parquet(f"{root}/bins")
    return back.select("series", "bin", "count", "min", "max", rounded("avg", 6))


@query(
    "x3_stream_activity",
    f"""WITH {user_events()}, a AS (SELECT ts_ns // {DAY} * {DAY} AS "window", series, count(*) AS n, max(seq) AS last_pulse FROM ev GROUP BY 1, 2)
SELECT "window", series, n, last_pulse, (row_number() OVER (PARTITION BY "window" ORDER BY n DESC, series))::INTEGER AS rank FROM a
WHERE "window" + {DAY} <= (SELECT max(epoch_ns(ts)) FROM events) - {HOUR} QUALIFY rank <= 6""",
)
def stream_activity(spark, sf_dir):
    root = scratch(spark)
    jobs.report_activity(stream(spark, sf_dir), f"{root}/report", f"{root}/checkpoint", window="1 day", delay="1 hour").awaitTermination()
    return spark.read.parquet(f"{root}/report").select("window", "series", "n", "last_pulse", "rank")


SILENT, CRITICAL = 24 * HOUR, 12 * HOUR
END = 1_706_659_200 * 1_000_000_000
SILENCE_SQL = f"""WITH {user_events()}, n AS (SELECT *, coalesce(lead(ts_ns) OVER (PARTITION BY series ORDER BY ts_ns, seq), {{end}}) AS nx FROM ev)
SELECT series, 'shutdown' AS alarm, ts_ns + {SILENT} AS alarm_ts_ns FROM n WHERE ts_ns + {SILENT} < nx
UNION ALL SELECT series, 'critical', ts_ns + {SILENT + CRITICAL} FROM n WHERE ts_ns + {SILENT + CRITICAL} < nx"""


@query("x4_silences", SILENCE_SQL.format(end=END))
def silences(spark, sf_dir):
    return lifecycle.silences(events(spark, sf_dir), END, ("series",), SILENT, CRITICAL)


@query("x4_stream_silences", SILENCE_SQL.format(end="(SELECT max(epoch_ns(ts)) // 1000000 * 1000000 FROM events)"))
def stream_silences(spark, sf_dir):
    root = scratch(spark)
    alarms = folds.silence_stream(stream(spark, sf_dir), "series", SILENT, CRITICAL)
    jobs.to_files(alarms, f"{root}/alarms", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(alarms.schema).parquet(f"{root}/alarms")


# Streams with one series of nine tenths of the rows, in three micro-batches, which slice it.
MOST = "CASE WHEN user_id % 10 = 0 THEN user_id ELSE -1 END"
STARTS = [1_704_067_200 * 1_000_000_000 + 10 * DAY * k for k in range(1, 3)]
SLICES = SlicePolicy(max_rows=400)


def in_three_batches(spark, sf_dir, by):
    """The events by time in three files, as a stream with one file in a micro-batch; gives it and a folder."""
    root = scratch(spark)
    rows = as_events(table(spark, sf_dir, "events").withColumn("_by", F.expr(by)), "_by")
    third = sum((F.col("ts_ns") >= t).cast("int") for t in STARTS)
    for k in range(3):
        rows.filter(third == k).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return jobs.follow(spark, f"{root}/in", rows.schema, files_per_trigger=1), f"{root}/out"


@query(
    "x1_stream_ingest_sliced",
    GATE_SQL + " SELECT series, seq FROM f WHERE admitted",
)
def stream_ingest_sliced(spark, sf_dir):
    rows, root = in_three_batches(spark, sf_dir, "user_id")
    sliced.ingest_batches(
        rows, root, f"{root}/checkpoint", IntervalGate(IVL, 0.05, REPORT), PartitionRoll(5, DAY, HOUR), GridChange(UNIT, SPACING),
        policy=SlicePolicy(max_rows=10, max_slices=50),
    ).awaitTermination()
    return tables.read(spark, root, "events_scalar").select("series", "seq")


SETTLED = "(SELECT max(epoch_ns(ts)) // 1000000 * 1000000 - 86400000000000 FROM events)"


@query(
    "x2_stream_bins_hot",
    bins_sql(MOST, HOUR, f"greatest(ts_ns, least(coalesce(nx, {SETTLED}), ts_ns + {2 * DAY}))")
    + f""" SELECT series, bin, "count", "min", "max", round("avg", 6) + 0.0 AS "avg" FROM b WHERE (bin + 1) * {HOUR} <= {SETTLED}""",
)
def stream_bins_hot(spark, sf_dir):
    """Bins a day behind the last event, each given once, from slices of the large series."""
    rows, root = in_three_batches(spark, sf_dir, MOST)
    sliced.bin_batches(rows, root, f"{root}/checkpoint", HOUR, DAY, max_carry_ns=2 * DAY, policy=SLICES).awaitTermination()
    found = bins.expand_runs(spark.read.parquet(f"{root}/bins").drop("batch"), HOUR)
    return found.select("series", "bin", "count", "min", "max", rounded("avg", 6))


@query(
    "x4_stream_silences_hot",
    SILENCE_SQL.format(end="(SELECT max(epoch_ns(ts)) // 1000000 * 1000000 FROM events)").replace("user_id", MOST),
)
def stream_silences_hot(spark, sf_dir):
    rows, root = in_three_batches(spark, sf_dir, MOST)
    sliced.silence_batches(rows, root, f"{root}/checkpoint", "series", SILENT, CRITICAL, policy=SLICES).awaitTermination()
    return spark.read.parquet(f"{root}/alarms").drop("batch")


@query(
    "j6_stream_answers",
    MATCH_SQL + f" WHERE ts_ns + {DAY} < least((SELECT max(ts_ns) FROM q), (SELECT max(ts_ns) FROM a)) // 1000000 * 1000000 - {HOUR}",
)
def stream_answers(spark, sf_dir):
    """Requests whose limit the final watermark has passed."""
    rows = stream(spark, sf_dir).withColumnRenamed("series", "channel")
    asked = rows.filter("kind = 'signup'").select("channel", "ts_ns", "seq")
    tag = lambda p: F.concat(F.lit(p), F.col("seq").cast("string"))
    answered = rows.filter("kind = 'purchase'").select("channel", "ts_ns", "seq", tag("r").alias("response_addr"), tag("a").alias("addr"))
    root = scratch(spark)
    matched = jobs.answer_stream(asked, answered, "channel", DAY, "1 hour")
    jobs.to_files(matched, f"{root}/found", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(matched.schema).parquet(f"{root}/found")


LIMITS = lifecycle.Timeouts(5 * HOUR, 2 * HOUR, 30 * HOUR, 20 * HOUR)


def lifecycle_log(rows):
    """Events as a lifecycle log: every type stands for an event of the channel of its user."""
    meaning = {"signup": "add", "click": "series", "view": "found", "purchase": "connection_done", "error": "not_found"}
    name = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in meaning.items()])
    addr = F.when(F.col("kind").isin("view", "purchase"), F.lit("10.0.0.1:5064"))
    return rows.select(F.col("series").cast("string").alias("channel"), "ts_ns", "seq", name.alias("event"), addr.alias("addr"))


_STAY = f"CASE st WHEN 'wait_status_series' THEN {5 * HOUR} WHEN 'unknown_address' THEN {2 * HOUR} WHEN 'search_pending' THEN {30 * HOUR} WHEN 'no_address' THEN {20 * HOUR} END"
LIFECYCLE_SQL = f"""WITH RECURSIVE ev AS (SELECT user_id::VARCHAR AS channel, epoch_ns(ts) AS ts_ns, event_id AS seq, event_type FROM events
  UNION ALL SELECT DISTINCT user_id::VARCHAR, {END}, 4611686018427387904, 'tick' FROM events),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY ts_ns, seq) AS i FROM ev),
f AS (SELECT channel, 0::BIGINT AS i, 'none' AS st, 0::BIGINT AS since, NULL::BIGINT AS moved, NULL::VARCHAR AS was FROM (SELECT DISTINCT channel FROM ev)
 UNION ALL SELECT channel, CASE WHEN due <= nts THEN i ELSE i + 1 END,
  CASE WHEN due <= nts THEN CASE st WHEN 'wait_status_series' THEN 'init' WHEN 'unknown_address' THEN 'search_pending'
    WHEN 'search_pending' THEN 'no_address' ELSE 'unknown_address' END ELSE nst END,
  CASE WHEN due <= nts THEN due WHEN nst <> st THEN nts ELSE since END,
  CASE WHEN due <= nts THEN due WHEN nst <> st THEN nts END,
  CASE WHEN due <= nts OR nst <> st THEN st END
 FROM (SELECT f.channel, f.i, st, since, o.ts_ns AS nts, since + {_STAY} AS due,
   CASE WHEN event_type = 'signup' AND st IN ('none', 'init') THEN 'wait_status_series'
    WHEN event_type = 'click' AND st IN ('init', 'wait_status_series') THEN 'unknown_address'
    WHEN event_type = 'view' AND st = 'search_pending' THEN 'assigned'
    WHEN event_type = 'error' AND st = 'search_pending' THEN 'no_address'
    WHEN event_type = 'purchase' AND st = 'assigned' THEN 'init' ELSE st END AS nst
   FROM f JOIN o ON o.channel = f.channel AND o.i = f.i + 1))"""


@query(
    "x5_lifecycle",
    LIFECYCLE_SQL + ' SELECT channel, moved AS ts_ns, was AS "before", st AS "after" FROM f WHERE moved IS NOT NULL',
)
def lifecycle_transitions(spark, sf_dir):
    log = lifecycle.with_end(lifecycle_log(events(spark, sf_dir)), END)
    return lifecycle.transitions(log, LIMITS).drop("addr")


@query(
    "x5_lifecycle_states",
    LIFECYCLE_SQL + " SELECT st AS state, count(*) AS n FROM (SELECT channel, arg_max(st, moved) AS st FROM f WHERE moved IS NOT NULL GROUP BY channel) GROUP BY st",
)
def lifecycle_state_counts(spark, sf_dir):
    log = lifecycle.with_end(lifecycle_log(events(spark, sf_dir)), END)
    states = lifecycle.current_states(lifecycle.transitions(log, LIMITS))
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x5_stream_lifecycle",
    LIFECYCLE_SQL.replace(str(END), "(SELECT max(epoch_ns(ts)) // 1000000 * 1000000 FROM events)")
    + ' SELECT channel, moved AS ts_ns, was AS "before", st AS "after" FROM f WHERE moved IS NOT NULL',
)
def stream_lifecycle(spark, sf_dir):
    root = scratch(spark)
    changes = folds.lifecycle_stream(lifecycle_log(stream(spark, sf_dir)), LIMITS)
    jobs.to_files(changes, f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(changes.schema).parquet(f"{root}/changes").drop("addr")


@query(
    "x7_status_items",
    LIFECYCLE_SQL
    + """ SELECT 'channel' AS item, channel AS name, moved AS ts_ns, 24 AS kind FROM f WHERE st = 'assigned' AND moved IS NOT NULL
UNION ALL SELECT 'connection', '10.0.0.1:5064', epoch_ns(ts), 6 FROM events WHERE event_type = 'purchase'""",
)
def status_item_rows(spark, sf_dir):
    log = lifecycle.with_end(lifecycle_log(events(spark, sf_dir)), END)
    changes = lifecycle.transitions(log, LIMITS)
    channel = lifecycle.channel_status_items(log, changes)
    connection = lifecycle.connection_status_items(log)
    return channel.select(F.lit("channel").alias("item"), F.col("channel").alias("name"), "ts_ns", "kind").unionByName(
        connection.select(F.lit("connection").alias("item"), F.col("addr").alias("name"), "ts_ns", "kind")
    )


# Statuses of channels and connections: all kinds, and ends that follow from state.

ALL_KINDS = [*lifecycle.CHANNEL_EVENT_KINDS, *lifecycle.CONNECTION_EVENT_KINDS]
KINDS_SQL = ", ".join(f"({i}, '{'channel' if e in lifecycle.CHANNEL_EVENT_KINDS else 'connection'}', {k})" for i, (e, k) in enumerate([*lifecycle.CHANNEL_EVENT_KINDS.items(), *lifecycle.CONNECTION_EVENT_KINDS.items()]))


@query(
    "x7_all_kinds",
    f"""SELECT item, CASE WHEN item = 'channel' THEN user_id::VARCHAR ELSE 'h' || user_id % 10 END AS name, epoch_ns(ts) AS ts_ns, kind
 FROM events JOIN (VALUES {KINDS_SQL}) k(i, item, kind) ON event_id % 17 = i
UNION ALL SELECT 'channel', user_id::VARCHAR, epoch_ns(ts), 24 FROM events WHERE event_id % 17 = 16""",
)
def all_status_kinds(spark, sf_dir):
    """A log with every status event; the seventeenth stands for an assignment."""
    names = F.array(*[F.lit(e) for e in ALL_KINDS])
    log = events(spark, sf_dir).select(
        F.col("series").cast("string").alias("channel"), "ts_ns", F.concat(F.lit("h"), F.col("series") % 10).alias("addr"),
        F.try_element_at(names, (F.col("seq") % 17 + 1).cast("int")).alias("event"), F.when(F.col("seq") % 17 == 16, "assigned").alias("after"),
    )
    channel = lifecycle.channel_status_items(log, log).select(F.lit("channel").alias("item"), F.col("channel").alias("name"), "ts_ns", "kind")
    return channel.unionByName(lifecycle.connection_status_items(log).select(F.lit("connection").alias("item"), F.col("addr").alias("name"), "ts_ns", "kind"))


END_NAMES = [*lifecycle.CONNECTION_ENDS, *lifecycle.CHANNEL_ENDS]
END_KINDS = ", ".join(f"({i}, {lifecycle.CHANNEL_EVENT_KINDS[r]})" for i, r in enumerate((lifecycle.CONNECTION_ENDS | lifecycle.CHANNEL_ENDS).values()))


@query(
    "x7_derived_ends",
    f"""WITH RECURSIVE e AS (SELECT *, epoch_ns(ts) AS t, user_id % 10 AS addr, event_id % 60 AS m FROM events),
r AS (SELECT event_id, t, user_id AS channel, CASE WHEN m >= 9 THEN 'created' ELSE 'end' END AS what, NULL::BIGINT AS kind, m FROM e WHERE m >= 6
  UNION ALL SELECT e.event_id, e.t, c.channel, 'end', NULL, m FROM e JOIN (SELECT DISTINCT user_id AS channel, user_id % 10 AS addr FROM events) c USING (addr) WHERE m < 6),
k AS (SELECT event_id, t, channel, what, v.kind FROM r LEFT JOIN (VALUES {END_KINDS}) v(m, kind) ON r.m = v.m),
c AS (SELECT *, lag(what) OVER (PARTITION BY channel ORDER BY t, event_id) AS was FROM k)
SELECT channel::VARCHAR AS channel, 'h' || channel % 10 AS addr, t AS ts_ns, CASE WHEN what = 'created' THEN 1 ELSE kind END AS kind FROM c
 WHERE what = 'created' AND was IS DISTINCT FROM 'created' OR what = 'end' AND was = 'created'""",
)
def derived_ends(spark, sf_dir):
    """Users as channels of ten connections: six kinds of events end a connection, three a channel, the others create it."""
    kind = F.col("seq") % 60
    rows = events(spark, sf_dir).select(
        F.col("series").cast("string").alias("channel"), F.concat(F.lit("h"), F.col("series") % 10).alias("addr"), "ts_ns", "seq",
        F.when(kind < 9, F.try_element_at(F.array(*[F.lit(e) for e in END_NAMES]), (kind + 1).cast("int"))).otherwise("created").alias("event"),
    )
    ends = F.col("event").isin(*lifecycle.CONNECTION_ENDS)
    return lifecycle.derived_openings(rows.filter(~ends), rows.filter(ends).drop("channel"), policy=SlicePolicy(max_rows=500))


# Tables as versioned lists of files.

START = 1_704_067_200 * 1_000_000_000  # 2024-01-01


def in_batches(spark, sf_dir, n):
    """Events with their places, dealt to `n` batches by number."""
    rows = events(spark, sf_dir).withColumns({"shape_dims": F.array().cast("array<int>"), "scalar_type": F.lit("F64"), "fvalue": F.col("value")})
    return rows.drop("value").withColumn("_batch", F.col("seq") % n)


@query(
    "k13_stored_retention",
    f"""SELECT event_id AS seq, user_id AS series, epoch_ns(ts) AS ts_ns, value AS fvalue, {START} + (event_id % 6 + 1) * {5 * DAY} AS written_at
 FROM events WHERE event_id % 6 >= 3""",
)
def stored_retention(spark, sf_dir):
    """Six batches five days apart; after 30 days with a retention of 12 the last three are left, also of a file that holds older ones."""
    archived, rows, keep = archive_files.ArchiveFiles(spark, scratch(spark)), in_batches(spark, sf_dir, 6), {"scalar": 12 * DAY}
    for i in range(6):
        archived.append(tables.event_rows(rows.filter(F.col("_batch") == i)), "events", i, START + (i + 1) * 5 * DAY)
        if i == 3:  # joins the second to the fourth batch; the first is expired by then
            archived.compact("events", START + 21 * DAY, least=2, retention=keep)
    archived.expire("events", START + 30 * DAY, keep)
    back = archived.read("events_scalar", written_after=START + 18 * DAY)
    return back.select("seq", "series", "ts_ns", "fvalue", "written_at")


@query(
    "k14_tables",
    "SELECT ts::DATE AS date, count(*) AS n, count(DISTINCT event_id) AS n_events, count(*) AS n_before, true AS few_files FROM events GROUP BY 1",
)
def compacted_tables(spark, sf_dir):
    """Twelve micro-batches, joined to few files a day; a reader of the version before sees the same rows."""
    archived, rows = archive_files.ArchiveFiles(spark, scratch(spark)), in_batches(spark, sf_dir, 12)
    for i in range(12):
        archived.append(tables.event_rows(rows.filter(F.col("_batch") == i)), "events", i, START + i)
    before = archived.versions("events")[-1]
    archived.compact("events", START + 2 * HOUR)
    files = archived.files("events").groupBy("partition").agg(F.count("*").alias("files"))
    files = files.select(F.get_json_object("partition", "$.date").cast("date").alias("date"), (F.col("files") <= 2).alias("few_files"))
    now = archived.read("events_scalar").groupBy("date").agg(F.count("*").alias("n"), F.count_distinct("seq").alias("n_events"))
    then = archived.read("events_scalar", version=before).groupBy("date").agg(F.count("*").alias("n_before"))
    return now.join(then, "date").join(files, "date")


def archived_events(spark, sf_dir):
    """All events in files of a few thousand rows, with the indexes."""
    archived = archive_files.ArchiveFiles(spark, scratch(spark))
    archive_files.write_events(archived, _laid_out(spark, sf_dir), 0, START, rows_per_file=2000)
    return archived


@query(
    "s12_pruned_range",
    f"SELECT event_id AS seq, epoch_ns(ts) AS ts_ns, value AS fvalue FROM events WHERE user_id = 8 AND epoch_ns(ts) BETWEEN {FROM} AND {TO}",
)
def pruned_range(spark, sf_dir):
    """One channel of a time range, read from the files whose zones can hold it."""
    known = small_table(spark, [(8, "lab", "U8", 10, [], 0)], REGISTRY)
    return archive.read_channel(archived_events(spark, sf_dir), known, "lab", "U8", FROM, TO).select("seq", "ts_ns", "fvalue")


@query("j5_stored_series", GRID_SQL + " SELECT DISTINCT series FROM c WHERE grid BETWEEN 473600 AND 473650")
def stored_series(spark, sf_dir):
    """Active series by the stored grid index."""
    return archived_events(spark, sf_dir).read("series_by_ts_msp", from_time=473600, to_time=473650).select("series").distinct()
