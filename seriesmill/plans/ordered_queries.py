"""Bins, moving statistics, layout, gates and sampling over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.operators import bins, layout, sampling, statistics
from seriesmill.operators.slicing import SlicePolicy
from seriesmill.plans.driver_tables import events, waves
from seriesmill.plans.registered import SQL, numbered, query, rounded, user_events
from seriesmill.schemas import DAY, HOUR, SECOND

BINS_SQL = """WITH ev AS (SELECT {by} AS series, epoch_ns(ts) AS ts_ns, event_id AS seq, value FROM events),
n AS (SELECT *, lead(ts_ns) OVER (PARTITION BY series ORDER BY ts_ns, seq) AS nx FROM ev),
u AS (SELECT *, {until} AS til, ts_ns // {bin} AS b0 FROM n),
t AS (SELECT *, unnest(range(b0, greatest(b0, (til - 1) // {bin}) + 1)) AS bin FROM u),
w AS (SELECT *, greatest(least(til, (bin + 1) * {bin}) - greatest(ts_ns, bin * {bin}), 0)::DOUBLE AS overlap FROM t),
b AS (SELECT series, bin, count(*) FILTER (WHERE bin = b0) AS "count", min(value) AS "min", max(value) AS "max",
  CASE WHEN sum(overlap) > 0 THEN sum(value * overlap) / sum(overlap) ELSE arg_max(value, (ts_ns, seq)) END AS "avg"
  FROM w GROUP BY series, bin)"""


def bins_sql(by: str, bin_ns: int, until: str = "coalesce(nx, ts_ns)") -> str:
    return BINS_SQL.format(by=by, bin=bin_ns, until=until)


def _show_bins(binned):
    return binned.select("series", "bin", "bin_ts_ns", "count", "min", "max", rounded("avg", 6))


SHOW_BINS = ' SELECT series, bin, bin * {bin} AS bin_ts_ns, "count", "min", "max", round("avg", 6) + 0.0 AS "avg" FROM b'


@query("a8_time_weighted_bins", bins_sql("event_type", HOUR) + SHOW_BINS.format(bin=HOUR))
def time_weighted_bins(spark, sf_dir):
    return _show_bins(bins.time_weighted_bins(bins.binnable(events(spark, sf_dir, "event_type")), HOUR, max_carry_ns=None))


@query("a8_bins_per_user", bins_sql("user_id", DAY) + SHOW_BINS.format(bin=DAY))
def bins_per_user(spark, sf_dir):
    return _show_bins(bins.time_weighted_bins(events(spark, sf_dir), DAY, max_carry_ns=None))


RUNS_SQL = f"""WITH {user_events()},
n AS (SELECT *, coalesce(lead(ts_ns) OVER (PARTITION BY series ORDER BY ts_ns, seq), ts_ns) AS until FROM ev),
g AS (SELECT *, ts_ns // {HOUR} AS a, greatest(ts_ns // {HOUR}, (until - 1) // {HOUR}) AS b FROM n)
SELECT series, a + 1 AS first_bin, b - 1 AS last_bin, 0::BIGINT AS "count", value AS avg FROM g WHERE b - a > 2
UNION ALL SELECT series, a + 1, a + 1, 0, value FROM g WHERE b - a = 2"""


@query("a8_bin_runs", RUNS_SQL)
def bin_runs(spark, sf_dir):
    """Gaps between the events of a user, one row each, whatever their length."""
    runs = bins.bin_runs(events(spark, sf_dir), HOUR, max_carry_ns=None)
    return runs.filter("count = 0").select("series", "first_bin", "last_bin", "count", "avg")


CARRY = 2 * HOUR


@query(
    "a8_bins_limited_carry",
    bins_sql("user_id", HOUR, f"least(coalesce(nx, ts_ns), ts_ns + {CARRY})") + SHOW_BINS.format(bin=HOUR),
)
def bins_limited_carry(spark, sf_dir):
    return _show_bins(bins.time_weighted_bins(events(spark, sf_dir), HOUR, max_carry_ns=CARRY))


@query("a8_bins_sliced_series", bins_sql("event_type", HOUR) + SHOW_BINS.format(bin=HOUR))
def bins_sliced_series(spark, sf_dir):
    """The same bins with every series above a thousandth of this table's size cut into time slices."""
    rows = events(spark, sf_dir, "event_type")
    return _show_bins(bins.time_weighted_bins(rows, HOUR, max_carry_ns=None, policy=SlicePolicy(max_rows=1000)))


PATCHES_SQL = (
    bins_sql("event_type", HOUR)
    + """, p AS (SELECT *, bin // 4 AS off, count(*) OVER (PARTITION BY series, bin // 4) AS n FROM b)
SELECT series, 3600::BIGINT AS bin_len_sec, 4 AS bin_count, off // 1000 AS off_msp, off % 1000 AS off_lsp,
  (bin % 4)::INTEGER AS pos, "count", "min", "max", round("avg", 6) + 0.0 AS "avg" FROM p WHERE n = 4"""
)


@query("a9_bin_patches", PATCHES_SQL)
def bin_patches(spark, sf_dir):
    binned = bins.time_weighted_bins(events(spark, sf_dir, "event_type"), HOUR, max_carry_ns=None)
    patches = bins.bin_patches(binned, HOUR, 4).withColumn("bin_len_sec", F.col("bin_len_sec").cast("long"))
    arrays = F.arrays_zip("counts", "mins", "maxs", "avgs")
    head = ["series", "bin_len_sec", "bin_count", "off_msp", "off_lsp"]
    rows = patches.select(*head, F.posexplode(arrays).alias("pos", "_b"))
    return rows.select(
        *head,
        "pos",
        F.col("_b.counts").alias("count"),
        F.col("_b.mins").alias("min"),
        F.col("_b.maxs").alias("max"),
        rounded("_b.avgs", 6, "avg"),
    )


# Folds: the SQL walks along each series with a recursive query.

# Averages of two-digit values often lie exactly between two rounded numbers; this moves them off.
OFF_TIES = 1.23456789e-7

VALUE_EMA_SQL = f"""WITH RECURSIVE {numbered()},
f AS (SELECT series, i, seq, 0.05 * value AS ema, 0.95::DOUBLE * (0.05 * value * value) AS emv FROM o WHERE i = 1
 UNION ALL SELECT o.series, o.i, o.seq, f.ema + 0.05 * (o.value - f.ema),
  0.95::DOUBLE * (f.emv + 0.05 * (o.value - f.ema) * (o.value - f.ema))
 FROM f JOIN o ON o.series = f.series AND o.i = f.i + 1)"""


@query(
    "w1_value_ema",
    VALUE_EMA_SQL + " SELECT series, seq, i AS ema_count, "
    f"round(ema + {OFF_TIES}, 6) + 0.0 AS ema, round(emv + {OFF_TIES}, 4) + 0.0 AS emv FROM f",
)
def value_ema(spark, sf_dir):
    out = statistics.value_ema(events(spark, sf_dir))
    return out.select("series", "seq", "ema_count", rounded(F.col("ema") + OFF_TIES, 6, "ema"), rounded(F.col("emv") + OFF_TIES, 4, "emv"))


def interval_sql(k: float) -> str:
    return f"""WITH RECURSIVE {numbered()},
d AS MATERIALIZED (SELECT *, (ts_ns - lag(ts_ns) OVER (PARTITION BY series ORDER BY i)) / 1e9 AS dt FROM o),
f AS (SELECT series, i, seq, ts_ns, 0.0::DOUBLE AS ema, 0.0::DOUBLE AS emv FROM d WHERE i = 1
 UNION ALL SELECT d.series, d.i, d.seq, d.ts_ns, f.ema + {k}::DOUBLE * (d.dt - f.ema),
  (1 - {k}::DOUBLE) * (f.emv + {k}::DOUBLE * (d.dt - f.ema) * (d.dt - f.ema))
 FROM f JOIN d ON d.series = f.series AND d.i = f.i + 1)"""


@query(
    "w2_interval_ema",
    interval_sql(0.05)
    + """ SELECT series, seq, i - 1 AS ema_count, CASE WHEN i > 1 THEN round(ema, 4) + 0.0 END AS ema,
 CASE WHEN i > 1 THEN round(sqrt(emv), 4) + 0.0 END AS emd FROM f""",
)
def interval_ema(spark, sf_dir):
    out = statistics.interval_ema(events(spark, sf_dir))
    return out.select("series", "seq", "ema_count", rounded("ema", 4), rounded(F.sqrt("emv"), 4, "emd"))


@query(
    "w3_ema_preview",
    interval_sql(0.05)
    + f" SELECT series, seq, round(ema + 0.05 * ((ts_ns + {HOUR} - ts_ns)::DOUBLE / 1e9 - ema), 4) + 0.0 AS preview FROM f",
)
def ema_preview(spark, sf_dir):
    out = statistics.interval_ema(events(spark, sf_dir))
    return out.select("series", "seq", rounded(statistics.ema_preview(F.col("ts_ns") + HOUR), 4, "preview"))


@query(
    "w15_rate_alarms",
    interval_sql(0.01) + " SELECT series, seq, i - 1 AS ema_count, round(ema, 4) + 0.0 AS ema FROM f WHERE i - 1 > 20 AND ema < 9000",
)
def rate_alarms(spark, sf_dir):
    out = statistics.rate_alarms(events(spark, sf_dir), ("series",), 0.01, 20, 9000.0)
    return out.select("series", "seq", "ema_count", rounded("ema", 4))


@query(
    "a11_channel_pings",
    interval_sql(0.05)
    + """ SELECT ts_ns // 86400000000000 AS day, series,
 CASE WHEN max(i) > 1 THEN round(arg_max(ema, i), 4) + 0.0 END AS ivl FROM f GROUP BY ts_ns // 86400000000000, series""",
)
def pings_per_day(spark, sf_dir):
    pings = statistics.channel_pings(events(spark, sf_dir))
    day = F.expr("minute div 86400").alias("day")
    latest = F.max_by("ivl", "minute")
    return pings.groupBy(day, "series").agg(rounded(latest, 4, "ivl"))


ROLL_SQL = f"""WITH RECURSIVE {numbered()},
f AS (SELECT series, i, seq, ts_ns, ts_ns - ts_ns % {HOUR} AS msp, 1 AS n, true AS bump FROM o WHERE i = 1
 UNION ALL SELECT o.series, o.i, o.seq, o.ts_ns,
  CASE WHEN f.n >= 5 OR f.msp + {DAY} <= o.ts_ns THEN o.ts_ns - o.ts_ns % {HOUR} ELSE f.msp END,
  CASE WHEN f.n >= 5 OR f.msp + {DAY} <= o.ts_ns
    THEN CASE WHEN o.ts_ns - o.ts_ns % {HOUR} = f.msp THEN f.n ELSE 1 END ELSE f.n + 1 END,
  (f.n >= 5 OR f.msp + {DAY} <= o.ts_ns) AND o.ts_ns - o.ts_ns % {HOUR} <> f.msp
 FROM f JOIN o ON o.series = f.series AND o.i = f.i + 1)"""


def rolled(spark, sf_dir, **how):
    return layout.roll_partitions(events(spark, sf_dir), ("series",), 5, DAY, HOUR, **how)


@query("w4_partition_roll", ROLL_SQL + " SELECT series, seq, msp AS ts_msp, ts_ns - msp AS ts_lsp, bump AS msp_bump FROM f")
def partition_roll(spark, sf_dir):
    return rolled(spark, sf_dir).select("series", "seq", "ts_msp", "ts_lsp", "msp_bump")


@query("k3_partition_index", ROLL_SQL + " SELECT DISTINCT series, msp AS ts_msp FROM f WHERE bump")
def partition_index(spark, sf_dir):
    return layout.partition_index(rolled(spark, sf_dir))


UNIT, SPACING = HOUR, 6
GRID_SQL = f"""WITH {user_events(", event_type")}, g AS (SELECT *, ts_ns // {UNIT} // {SPACING} * {SPACING} AS cell FROM ev),
c AS (SELECT *, CASE WHEN cell <> coalesce(lag(cell) OVER (PARTITION BY series ORDER BY ts_ns, seq), 0) THEN cell END AS grid FROM g)"""


@query("w5_grid_changes", GRID_SQL + " SELECT series, seq, grid AS ts_msp_grid FROM c")
def grid_changes(spark, sf_dir):
    return layout.mark_grid_changes(events(spark, sf_dir), unit=UNIT, spacing=SPACING).select("series", "seq", "ts_msp_grid")


@query(
    "k4_grid_index",
    GRID_SQL
    + """ SELECT DISTINCT (series & 255)::INTEGER AS part, grid AS ts_msp_grid, 0 AS shape_kind, 'F64' AS scalar_type, series
 FROM c WHERE grid IS NOT NULL""",
)
def grid_index(spark, sf_dir):
    return layout.grid_index(layout.mark_grid_changes(events(spark, sf_dir), unit=UNIT, spacing=SPACING))


IVL, REPORT = 8 * HOUR, 12 * HOUR
_DV = "((o.ts_ns - f.last) / 1e9 - f.ema)"
_EMA2 = f"(f.ema + 0.05::DOUBLE * {_DV})"
GATE_SQL = f"""WITH RECURSIVE {numbered()},
f AS (SELECT series, i, seq, ts_ns, true AS admitted, 0.0::DOUBLE AS ema, 0.0::DOUBLE AS emv, 0 AS n, ts_ns AS last,
  ts_ns + floor({IVL / 1e9}::DOUBLE / 0.05::DOUBLE * 1e6::DOUBLE)::BIGINT * 1000 AS nxt, ts_ns AS rep, false AS report FROM o WHERE i = 1
 UNION ALL SELECT o.series, o.i, o.seq, o.ts_ns, o.ts_ns >= f.nxt,
  CASE WHEN o.ts_ns >= f.nxt THEN {_EMA2} ELSE f.ema END,
  CASE WHEN o.ts_ns >= f.nxt THEN (1 - 0.05::DOUBLE) * (f.emv + 0.05::DOUBLE * {_DV} * {_DV}) ELSE f.emv END,
  CASE WHEN o.ts_ns >= f.nxt THEN f.n + 1 ELSE f.n END,
  CASE WHEN o.ts_ns >= f.nxt THEN o.ts_ns ELSE f.last END,
  CASE WHEN o.ts_ns >= f.nxt
    THEN o.ts_ns + floor(greatest(0.0::DOUBLE, {IVL / 1e9}::DOUBLE - {_EMA2}) / 0.05::DOUBLE * 1e6::DOUBLE)::BIGINT * 1000 ELSE f.nxt END,
  CASE WHEN o.ts_ns < f.nxt AND o.ts_ns - f.rep >= {REPORT} THEN o.ts_ns ELSE f.rep END,
  o.ts_ns < f.nxt AND o.ts_ns - f.rep >= {REPORT}
 FROM f JOIN o ON o.series = f.series AND o.i = f.i + 1)"""


def gated(spark, sf_dir, **how):
    return statistics.gate(events(spark, sf_dir), ivl_ns=IVL, report_ns=REPORT, **how)


@query(
    "w6_interval_gate",
    GATE_SQL + " SELECT series, seq, admitted, CASE WHEN n > 0 THEN round(ema, 4) + 0.0 END AS ivl_ema FROM f",
)
def interval_gate(spark, sf_dir):
    return gated(spark, sf_dir).select("series", "seq", "admitted", rounded("ivl_ema", 4))


@query(
    "w6_gate_counts",
    GATE_SQL + """ SELECT series, count(*) FILTER (WHERE admitted) AS admitted,
 count(*) FILTER (WHERE NOT admitted) AS dropped FROM f GROUP BY series""",
)
def gate_counts(spark, sf_dir):
    return statistics.dropped_counts(gated(spark, sf_dir))


@query(
    "w7_interval_reports",
    GATE_SQL + " SELECT series, ts_ns, round(ema, 4) + 0.0 AS ema, round(sqrt(emv), 4) + 0.0 AS emd FROM f WHERE report",
)
def interval_reports(spark, sf_dir):
    out = statistics.interval_reports(gated(spark, sf_dir))
    return out.select("series", "ts_ns", rounded("ema", 4), rounded("emd", 4))


_P = f"(f.ema + 0.1::DOUBLE * (least(o.ts_ns - f.last, {12 * HOUR}) / 1e9 - f.ema))"
_PASS = f"NOT (o.event_type <> 'error' AND {_P} < (1 / (1 / 21600.0::DOUBLE)))"
LIMIT_SQL = f"""WITH RECURSIVE {numbered(", event_type")},
f AS (SELECT series, i, seq, true AS forwarded, 1 / (1 / 21600.0::DOUBLE) AS ema, ts_ns AS last FROM o WHERE i = 1
 UNION ALL SELECT o.series, o.i, o.seq, {_PASS}, CASE WHEN {_PASS} THEN {_P} ELSE f.ema END,
  CASE WHEN {_PASS} THEN o.ts_ns ELSE f.last END
 FROM f JOIN o ON o.series = f.series AND o.i = f.i + 1)
SELECT series, seq, forwarded, round(ema, 4) + 0.0 AS forward_ema FROM f"""


@query("w8_rate_limiter", LIMIT_SQL)
def rate_limiter(spark, sf_dir):
    items = events(spark, sf_dir).withColumn("droppable", F.col("kind") != "error")
    out = statistics.limit_rate(items, ("series",), 1 / 21600.0, k=0.1, cap_ns=12 * HOUR)
    return out.select("series", "seq", "forwarded", rounded("forward_ema", 4))


@query(
    "w16_throttle",
    f"""WITH RECURSIVE {numbered()},
f AS (SELECT series, i, seq, ts_ns AS last, true AS emitted FROM o WHERE i = 1
 UNION ALL SELECT o.series, o.i, o.seq, CASE WHEN o.ts_ns - f.last >= {DAY} THEN o.ts_ns ELSE f.last END, o.ts_ns - f.last >= {DAY}
 FROM f JOIN o ON o.series = f.series AND o.i = f.i + 1)
SELECT series, seq, emitted FROM f""",
)
def throttle(spark, sf_dir):
    return statistics.throttle(events(spark, sf_dir), every_ns=DAY).select("series", "seq", "emitted")


# The same folds with the series cut into slices and repaired.
SMALL = SlicePolicy(max_rows=50)


@query("w4_partition_roll_sliced", ROLL_SQL + " SELECT series, seq, msp AS ts_msp, ts_ns - msp AS ts_lsp, bump AS msp_bump FROM f")
def partition_roll_sliced(spark, sf_dir):
    return rolled(spark, sf_dir, policy=SMALL).select("series", "seq", "ts_msp", "ts_lsp", "msp_bump")


@query("w1_value_ema_sliced", SQL["w1_value_ema"])
def value_ema_sliced(spark, sf_dir):
    out = statistics.value_ema(events(spark, sf_dir), policy=SMALL)
    return out.select("series", "seq", "ema_count", rounded(F.col("ema") + OFF_TIES, 6, "ema"), rounded(F.col("emv") + OFF_TIES, 4, "emv"))


@query("w2_interval_ema_sliced", SQL["w2_interval_ema"])
def interval_ema_sliced(spark, sf_dir):
    out = statistics.interval_ema(events(spark, sf_dir), policy=SMALL)
    return out.select("series", "seq", "ema_count", rounded("ema", 4), rounded(F.sqrt("emv"), 4, "emd"))


@query("w6_interval_gate_sliced", SQL["w6_interval_gate"])
def interval_gate_sliced(spark, sf_dir):
    return gated(spark, sf_dir, policy=SMALL).select("series", "seq", "admitted", rounded("ivl_ema", 4))


@query("w8_rate_limiter_sliced", LIMIT_SQL)
def rate_limiter_sliced(spark, sf_dir):
    items = events(spark, sf_dir).withColumn("droppable", F.col("kind") != "error")
    out = statistics.limit_rate(items, ("series",), 1 / 21600.0, k=0.1, cap_ns=12 * HOUR, policy=SMALL)
    return out.select("series", "seq", "forwarded", rounded("forward_ema", 4))


# Sampling, copies, batches, upsert and retention.


@query(
    "w9_fraction_sampling",
    f"""WITH {user_events(", event_type")} SELECT event_type AS source, seq FROM ev
QUALIFY (row_number() OVER (PARTITION BY event_type ORDER BY ts_ns, seq) - 1) % 1000 < 300""",
)
def fraction_sampling(spark, sf_dir):
    items = events(spark, sf_dir, "event_type").withColumnRenamed("series", "source")
    return sampling.sample_fraction(items, 300).select("source", "seq")


COPIES_SQL = f"""WITH {user_events(", event_type")},
c AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts_ns, seq) - 1 AS c FROM ev)
SELECT event_type AS source, seq, ts_ns, NULL::INTEGER AS copy FROM c
UNION ALL SELECT event_type, seq, ts_ns - 1, 0 FROM c WHERE c % 3 = 1
UNION ALL SELECT event_type, seq, ts_ns - 2, 1 FROM c WHERE c % 7 = 2"""


@query("w10_load_copies", COPIES_SQL)
def load_copies(spark, sf_dir):
    items = events(spark, sf_dir, "event_type").withColumnRenamed("series", "source")
    return sampling.with_load_copies(items, [(3, 1), (7, 2)]).select("source", "seq", "ts_ns", "copy")


BATCH_SQL = f"""WITH {user_events()}, o AS (SELECT *, row_number() OVER w AS i, lag(ts_ns) OVER w AS before FROM ev
  WINDOW w AS (PARTITION BY series ORDER BY ts_ns, seq)),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts_ns - before > {12 * HOUR} THEN 1 ELSE 0 END)
  OVER (PARTITION BY series ORDER BY i)::BIGINT AS session FROM o),
b AS (SELECT *, (row_number() OVER (PARTITION BY series, session ORDER BY i) - 1) // 4 AS batch FROM s)"""


@query(
    "w14_idle_batches",
    BATCH_SQL + """ SELECT series, session, batch, count(*) AS n, min(ts_ns) AS first_ts, max(ts_ns) AS last_ts
 FROM b GROUP BY series, session, batch""",
)
def idle_batches(spark, sf_dir):
    batched = sampling.batches(events(spark, sf_dir), 4, 12 * HOUR, ("series",))
    return sampling.batch_sizes(batched, ("series",))


@query(
    "w14_idle_batches_sliced",
    BATCH_SQL + " SELECT series, seq, session, batch FROM b",
)
def idle_batches_sliced(spark, sf_dir):
    batched = sampling.batches(events(spark, sf_dir), 4, 12 * HOUR, ("series",), policy=SMALL)
    return batched.select("series", "seq", "session", "batch")


@query(
    "k12_last_write_wins",
    f"""WITH {user_events()}, k AS (SELECT series, ts_ns // {DAY} AS day, seq, value, ts_ns AS written_at FROM ev)
SELECT series, day, seq, value, written_at FROM k
QUALIFY row_number() OVER (PARTITION BY series, day ORDER BY written_at DESC, seq DESC) = 1""",
)
def last_write_wins(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "series", F.expr(f"ts_ns div {DAY}").alias("day"), "seq", "value", F.col("ts_ns").alias("written_at")
    )
    return layout.last_write_wins(rows, ("series", "day"))


NOW = 1_706_659_200 * 1_000_000_000  # 2024-01-31


@query(
    "k13_retention",
    f"""SELECT event_id AS seq, event_type AS item_class FROM events WHERE epoch_ns(ts) +
  CASE event_type WHEN 'view' THEN {3 * DAY} WHEN 'click' THEN {DAY} WHEN 'error' THEN {12 * HOUR} ELSE {40 * DAY} END > {NOW}""",
)
def retention(spark, sf_dir):
    named = {"view": "index", "click": "scalar", "error": "array"}
    kind = F.coalesce(*[F.when(F.col("kind") == k, F.lit(c)) for k, c in named.items()], F.lit("binned"))
    rows = events(spark, sf_dir).withColumn("written_at", F.col("ts_ns"))
    return layout.unexpired(rows, NOW, kind).select("seq", F.col("kind").alias("item_class"))


@query(
    "k13_retention_scan",
    "SELECT vec_id AS seq FROM embeddings WHERE vec_id > 100",
)
def retention_scan(spark, sf_dir):
    rows = waves(spark, sf_dir).withColumnRenamed("ts_ns", "written_at")
    return layout.unexpired(rows, 12 * HOUR + 100 * SECOND, "array").select("seq")


@query("s9_pulse_scan", "SELECT epoch_ns(ts) // 1000000000 AS tsa, (epoch_ns(ts) % 1000000000)::BIGINT AS tsb, event_id AS pulse FROM events")
def pulse_scan(spark, sf_dir):
    from seriesmill.functions.times import second_and_nanos
    from seriesmill.sources.archive import list_pulses

    tsa, tsb = second_and_nanos("ts_ns")
    return list_pulses(events(spark, sf_dir).select(tsa.alias("tsa"), tsb.alias("tsb"), "pulse"))


@query("s10_distinct_keys", "SELECT DISTINCT event_id >> 14 AS pulse_a FROM events")
def distinct_keys(spark, sf_dir):
    from seriesmill.functions.values import pulse_split
    from seriesmill.operators.reports import distinct_keys as keys

    return keys(events(spark, sf_dir).select(pulse_split("pulse")[0].alias("pulse_a")))


@query("a7_greatest_key", "SELECT max(event_id >> 14) AS pulse_a FROM events")
def greatest_key(spark, sf_dir):
    from seriesmill.functions.values import pulse_split
    from seriesmill.operators.reports import greatest_key as key

    return key(events(spark, sf_dir).select(pulse_split("pulse")[0].alias("pulse_a")))
