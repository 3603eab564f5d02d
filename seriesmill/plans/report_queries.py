"""Quality classes, reports, scalar functions and captures."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions import times, values
from seriesmill.functions.binary import strip_terminator
from seriesmill.operators import quality, reports, statistics
from seriesmill.plans.driver_tables import (
    big_endian,
    device_frames,
    double_bytes,
    events,
    little_endian,
    messages,
    nanos,
    table,
    waves,
)
from seriesmill.plans.ordered_queries import ROLL_SQL, interval_sql, rolled
from seriesmill.plans.registered import query, rounded
from seriesmill.schemas import DAY, HOUR, SECOND
from seriesmill.sources import captures, device_events
from seriesmill.sources.text import channel_lines

# Filters and quality classes.


@query(
    "f1_channel_include",
    "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^red') OR NOT regexp_matches(p_name, 'ring$|bolt$')",
)
def channel_include(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return quality.include_channels(parts, "^red", "ring$|bolt$", "p_name")


@query("f2_channel_find", "SELECT page_id, url FROM pages WHERE regexp_matches(url, 'blog\\.[a-z]+\\.example\\.(com|net)/en')")
def channel_find(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return quality.find_channels(pages, r"blog\.[a-z]+\.example\.(com|net)/en", "url")


@query(
    "s8_channel_list",
    """WITH l AS (SELECT trim(unnest(string_split(text, chr(10)))) AS channel FROM conversations)
SELECT channel, count(*) AS n FROM l WHERE channel <> '' AND NOT (regexp_matches(channel, '^[A-D]') AND NOT regexp_matches(channel, '^Al')) GROUP BY channel""",
)
def channel_list(spark, sf_dir):
    """The lines of all texts as a channel list, with how often each occurs."""
    lines = table(spark, sf_dir, "conversations").select(F.explode(F.split("text", "\n")).alias("value"))
    return channel_lines(lines, "^Al", "^[A-D]").groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


SKEW_SQL = """WITH j AS (SELECT l_orderkey, l_linenumber, epoch_ns(l_shipdate) AS ts_ns, epoch_ns(o_orderdate) + (l_orderkey % 5) * 86400000000000 AS arrival
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT *, abs(ts_ns - arrival) // 86400 AS apart FROM j)
SELECT CASE WHEN apart > 300000000000 THEN 300 WHEN apart > 120000000000 THEN 120 WHEN apart > 20000000000 THEN 20
  WHEN apart > 3000000000 THEN 3 ELSE 0 END AS skew_over_s, count(*) AS n FROM d GROUP BY 1"""


@query("f4_clock_skew", SKEW_SQL)
def clock_skew(spark, sf_dir):
    """Ship date against order date, a day counted as a second."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", nanos("l_shipdate").alias("ship"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), nanos("o_orderdate").alias("ordered"))
    rows = lines.join(orders, "l_orderkey").withColumn("arrival", F.col("ordered") + (F.col("l_orderkey") % 5) * DAY)
    scaled = rows.select((F.lit(0).cast("long")).alias("ts_ns"), F.expr("abs(ship - arrival) div 86400").alias("arrival_ns"))
    return quality.skew_counts(scaled)


@query(
    "f5_pulse_range",
    "SELECT l_orderkey, l_linenumber, l_partkey, pulse <> 0 AND NOT pulse BETWEEN 14781000000 AND 49000000000 AS bad FROM "
    "(SELECT *, l_orderkey * 3000000 AS pulse FROM lineitem)",
)
def pulse_range(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", quality.pulse_out_of_range(F.col("l_orderkey") * 3_000_000).alias("bad"))


@query(
    "f6_pulse_time_congruence",
    "SELECT event_id AS seq, (event_id * 1000) % 1000000 = epoch_ns(ts) % 1000000 AS agrees FROM events",
)
def pulse_time_congruence(spark, sf_dir):
    rows = events(spark, sf_dir)
    return rows.select("seq", quality.pulse_matches_time(F.col("pulse") * 1000).alias("agrees"))


# Captured messages. The SQL states what each message was made from.

GOOD = "event_id % 17 <> 0 AND event_id % 13 <> 0"


def good_messages(spark, sf_dir):
    return captures.decode_headers(messages(spark, sf_dir))[0]


@query(
    "s2_message_headers",
    f"""SELECT event_id AS msg_id, event_id + 14780999000 AS pulse, epoch_ns(ts) AS ts_ns, 'bsr_m-1.1' AS htype,
 CASE WHEN event_id % 7 = 0 THEN 3 ELSE 2 END AS n_channels FROM events WHERE {GOOD}""",
)
def message_headers(spark, sf_dir):
    return good_messages(spark, sf_dir).select("msg_id", "pulse", "ts_ns", "htype", F.size("channels").alias("n_channels"))


@query(
    "s2_rejected_messages",
    f"""SELECT event_id AS msg_id, CASE WHEN event_id % 17 = 0 THEN 'too few frames' ELSE 'compressed data header' END AS reason
FROM events WHERE NOT ({GOOD})""",
)
def rejected_messages(spark, sf_dir):
    return captures.decode_headers(messages(spark, sf_dir))[1].select("msg_id", "reason")


@query(
    "s3_channel_descriptors",
    f"""WITH m AS (SELECT event_id AS msg_id, unnest(CASE WHEN event_id % 7 = 0 THEN [0, 1, 2] ELSE [0, 1] END) AS pos FROM events WHERE {GOOD})
SELECT msg_id, pos, ['value', 'count', 'note'][pos + 1] AS channel, ['F64', 'I32', 'STRING'][pos + 1] AS scalar_type, pos = 0 AS big_endian,
 0 AS rank FROM m""",
)
def channel_descriptors(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir))
    return rows.select("msg_id", "pos", "channel", "scalar_type", "big_endian", F.size("shape_dims").alias("rank"))


@query(
    "s4_channel_frames",
    f"""WITH m AS (SELECT *, unnest(CASE WHEN event_id % 7 = 0 THEN [0, 1, 2] ELSE [0, 1] END) AS pos FROM events WHERE {GOOD})
SELECT event_id AS msg_id, ['value', 'count', 'note'][pos + 1] AS channel,
 CASE pos WHEN 0 THEN 8 WHEN 1 THEN 4 ELSE length(event_type)::INTEGER END AS bytes, epoch_ns(ts) AS frame_ts_ns FROM m""",
)
def channel_frames(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir))
    return captures.frame_times(rows).select("msg_id", "channel", F.octet_length("payload").alias("bytes"), "frame_ts_ns")


@query(
    "s4_wide_messages",
    "SELECT event_id // 1000 AS msg_id, 'c' || event_id || '.' || j AS channel, event_id AS i FROM events, range(5) r(j)",
)
def wide_messages(spark, sf_dir):
    """Messages of up to 5000 channels, five for each of a thousand events; every channel is read."""
    n = F.col("event_id")
    channels = table(spark, sf_dir, "events").select(F.floor(n / 1000).alias("msg_id"), n, F.explode(F.sequence(F.lit(0), F.lit(4))).alias("j"))
    name = F.concat(F.lit("c"), n.cast("string"), F.lit("."), F.col("j").cast("string"))
    one = F.struct(n, "j", F.concat(F.lit('{"name":"'), name, F.lit('","type":"int32"}')).alias("head"), little_endian(n, 4).alias("value"))
    packed = channels.groupBy("msg_id").agg(F.array_sort(F.collect_list(one)).alias("c"))
    head = F.concat(F.lit('{"htype":"bsr_d-1.1","channels":['), F.array_join(F.col("c.head"), ","), F.lit("]}"))
    packed = packed.withColumn("head", head)
    main = F.concat(F.lit('{"htype":"bsr_m-1.1","pulse_id":1,"hash":"'), F.md5("head"), F.lit('","global_timestamp":{"sec":1,"ns":0}}'))
    stamp = F.lit(bytearray(16))
    body = F.flatten(F.transform("c", lambda x: F.array(x["value"], stamp)))
    messages = packed.select("msg_id", F.lit("wide").alias("source"), F.lit(0).cast("long").alias("recv_ts_ns"), F.concat(F.array(main.cast("binary"), F.col("head").cast("binary")), body).alias("frames"))
    rows, _ = captures.channel_frames(captures.decode_headers(messages)[0])
    return captures.decode_frames(rows).select("msg_id", "channel", F.element_at("ints", 1).alias("i"))


@query(
    "s5_typed_values",
    f"""SELECT event_id AS msg_id, 'value' AS channel, NULL::BIGINT AS i, value AS f, NULL AS text FROM events WHERE {GOOD}
UNION ALL SELECT event_id, 'count', event_id, NULL, NULL FROM events WHERE {GOOD}
UNION ALL SELECT event_id, 'note', NULL, NULL, event_type FROM events WHERE {GOOD} AND event_id % 7 = 0""",
)
def typed_values(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir))
    first = lambda c: F.try_element_at(c, F.lit(1))
    return captures.decode_frames(rows).select("msg_id", "channel", first("ints").alias("i"), first("floats").alias("f"), "text")


@query(
    "f7_f8_message_checks",
    f"""SELECT event_id AS msg_id, true AS frames_ok, event_id % 11 <> 0 AS hash_ok,
 NOT event_id + 14780999000 BETWEEN 14781000000 AND 49000000000 AS pulse_out_of_range,
 (event_id + 14780999000) % 1000000 = epoch_ns(ts) % 1000000 AS pulse_matches_time FROM events WHERE {GOOD}""",
)
def message_checks(spark, sf_dir):
    checked = captures.with_quality(good_messages(spark, sf_dir))
    return checked.select("msg_id", "frames_ok", "hash_ok", "pulse_out_of_range", "pulse_matches_time")


@query(
    "f9_channel_limit",
    f"""SELECT event_id AS msg_id, unnest(['value', 'count']) AS channel FROM events WHERE {GOOD}""",
)
def channel_limit(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir), most=2)
    return rows.select("msg_id", "channel")


@query("f10_named_channels", f"SELECT event_id AS msg_id, 'note' AS channel FROM events WHERE {GOOD} AND event_id % 7 = 0")
def named_channels(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir))
    return quality.pick_channels(rows, ["note", "other"]).select("msg_id", "channel")


@query(
    "w12_header_changes",
    f"""SELECT event_id AS msg_id, coalesce((event_id % 7 = 0) <> lag(event_id % 7 = 0) OVER (PARTITION BY user_id ORDER BY ts, event_id), false)
 AS header_changed FROM events WHERE {GOOD}""",
)
def header_changes(spark, sf_dir):
    changed = quality.header_changes(good_messages(spark, sf_dir), order=("ts_ns", "msg_id"))
    return changed.select("msg_id", "header_changed")


BYTES = "(12 + CASE WHEN event_id % 7 = 0 THEN length(event_type) ELSE 0 END)"


@query("a6_payload_bytes", f"SELECT user_id::VARCHAR AS source, event_id AS msg_id, {BYTES}::BIGINT AS payload_bytes FROM events WHERE {GOOD}")
def payload_bytes(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir))
    return reports.payload_sizes(rows).drop("recv_ts_ns")


@query(
    "a6_payload_rates",
    f"""SELECT user_id::VARCHAR AS source, epoch_ns(ts) // {DAY} AS "window", count(*) AS messages, sum({BYTES})::BIGINT AS payload_bytes,
 round(sum({BYTES}) / 1000.0 / 86400, 9) + 0.0 AS kb_per_s FROM events WHERE {GOOD} GROUP BY 1, 2""",
)
def payload_rates(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir))
    rates = reports.payload_rates(reports.payload_sizes(rows), DAY)
    return rates.select("source", "window", "messages", "payload_bytes", rounded("kb_per_s", 9))


@query("p17_pulse_map", f"SELECT floor(value)::BIGINT AS pulse, epoch_ns(ts) AS ts_ns FROM events WHERE {GOOD}")
def pulse_map(spark, sf_dir):
    rows, _ = captures.channel_frames(good_messages(spark, sf_dir))
    return captures.pulse_map(rows, ("value",))


@query(
    "p18_global_time_and_pulse",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS pulse,
 CASE WHEN event_id % 2 = 0 THEN 0 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS checked,
 (event_id * 1000000000 + CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS ts_ns FROM events""",
)
def global_time_and_pulse(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_id") % 2 == 0, F.concat(k, F.lit(".5"))).otherwise(k)
    return table(spark, sf_dir, "events").select(
        "event_id",
        values.pulse_id(k).alias("pulse"),
        values.pulse_id(text).alias("checked"),
        times.global_time_ns(F.col("event_id"), k.cast("long")).alias("ts_ns"),
    )


# Device event frames.

FRAME_KIND = "['STRING', 'I16', 'I16', 'I8', 'I32', 'F64', 'I32', 'I32'][event_id % 8 + 1]"


@query(
    "s6_device_events",
    f"""SELECT event_id AS seq, user_id AS subid, {FRAME_KIND} AS scalar_type, epoch_ns(ts) AS ts_ns, nullif(event_id % 3, 0) AS status,
 nullif(event_id % 4, 0) AS severity,
 CASE event_id % 8 WHEN 1 THEN event_id % 30000 WHEN 2 THEN event_id % 100 WHEN 3 THEN event_id % 100 WHEN 4 THEN event_id WHEN 6 THEN event_id + 1 END AS i,
 CASE WHEN event_id % 8 = 5 THEN value END AS f, CASE WHEN event_id % 8 = 0 THEN event_type END AS text,
 CASE WHEN event_id % 8 = 6 THEN 3 ELSE 0 END AS wave FROM events WHERE event_id % 8 <> 7""",
)
def device_event_rows(spark, sf_dir):
    """Every frame decoded; `i` is the last element of at most two that are kept of a wave."""
    good, _ = device_events.decode_events(device_frames(spark, sf_dir), array_truncate=2)
    return good.select(
        "seq",
        "subid",
        "scalar_type",
        "ts_ns",
        "status",
        "severity",
        F.try_element_at("ints", F.lit(-1)).alias("i"),
        F.try_element_at("floats", F.lit(1)).alias("f"),
        "text",
        F.coalesce(F.try_element_at("shape_dims", F.lit(1)), F.lit(0)).alias("wave"),
    )


@query(
    "s6_long_waves",
    """SELECT event_id // 1000 AS seq, (3 * count(*))::INTEGER AS n, round(3 * sum(value), 2) + 0.0 AS total, false AS truncated FROM events GROUP BY 1""",
)
def long_waves(spark, sf_dir):
    """Waves of up to 3000 elements, three for each of a thousand events; none is cut."""
    values = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 1000).alias("seq"), F.hex(double_bytes("value")).alias("v"))
    waves = values.groupBy("seq").agg(F.array_join(F.collect_list("v"), "").alias("v"), (F.count("*") * 3).cast("int").alias("n"))
    frames = waves.select(
        "seq", F.lit(0).cast("long").alias("recv_ts_ns"), F.lit(1).alias("cmdid"), F.lit(20).alias("data_type"), F.col("n").alias("data_count"),
        F.lit(1).cast("long").alias("param1"), F.lit(0).cast("long").alias("param2"),
        F.unhex(F.concat(F.lit("00" * 8 + "00000001" + "00" * 4), F.repeat("v", F.lit(3)))).alias("payload"),
    )
    good, _ = device_events.decode_events(frames)
    total = F.aggregate("floats", F.lit(0.0), lambda a, x: a + x)
    return good.select("seq", F.size("floats").alias("n"), rounded(total, 2, "total"), "truncated")


@query("s6_rejected_frames", "SELECT event_id AS seq, 'not a time type' AS reason FROM events WHERE event_id % 8 = 7")
def rejected_frames(spark, sf_dir):
    return device_events.decode_events(device_frames(spark, sf_dir))[1].select("seq", "reason")


@query(
    "s7_request_types",
    """WITH d AS (SELECT unnest(range(21))::INTEGER AS data_type)
SELECT event_id AS seq, ['plain', 'status', 'time'][data_type // 7 + 1] AS meta,
 ['STRING', 'I16', 'F32', 'ENUM', 'I8', 'I32', 'F64'][data_type % 7 + 1] AS ca_scalar_type
FROM events LEFT JOIN d ON event_id % 23 = data_type""",
)
def request_types(spark, sf_dir):
    frames = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), (F.col("event_id") % 23).cast("int").alias("data_type"))
    return device_events.with_types(frames).select("seq", "meta", "ca_scalar_type")


# Scalar functions.


@query(
    "p1_p2_p3_p11_time_parts",
    f"""SELECT event_id AS seq, ts_ns - (ts_ns - ts_ns % {DAY}) AS ts_lsp, ts_ns // {HOUR} // 6 * 6 AS grid, ts_ns - ts_ns % {HOUR} AS status_msp,
 ts_ns % {HOUR} AS status_lsp, ts_ns // 60000000000 * 60 AS minute FROM (SELECT event_id, epoch_ns(ts) AS ts_ns FROM events)""",
)
def time_parts(spark, sf_dir):
    msp, lsp = times.status_split("ts_ns", HOUR)
    rows = events(spark, sf_dir).withColumn("ts_msp", times.floor_to("ts_ns", DAY))
    return rows.select(
        "seq",
        times.offset_in_partition().alias("ts_lsp"),
        times.grid_cell("ts_ns", HOUR, 6).alias("grid"),
        msp.alias("status_msp"),
        lsp.alias("status_lsp"),
        times.minute_floor().alias("minute"),
    )


@query(
    "p4_p5_device_time",
    """SELECT event_id AS seq, ((event_id + 631152000) * 1000000000 + event_id % 1000)::BIGINT AS ts_ns, nullif(event_id % 3, 0) AS status,
 coalesce(nullif(event_id % 3, 0), 0) AS back FROM events""",
)
def device_time(spark, sf_dir):
    n = F.col("event_id")
    status = times.null_if_zero(n % 3)
    return table(spark, sf_dir, "events").select(
        n.alias("seq"),
        times.null_if_zero(times.device_time_ns(n, n % 1000)).alias("ts_ns"),
        status.alias("status"),
        times.zero_if_null(status).alias("back"),
    )


@query(
    "p6_k2_truncated_waves",
    """SELECT vec_id AS seq, unnest(range(1, least(10, len(embedding)) + 1))::INTEGER AS pos,
 round(unnest(embedding[1:10])::DOUBLE, 6) + 0.0 AS x FROM embeddings""",
)
def truncated_waves(spark, sf_dir):
    rows = waves(spark, sf_dir).select("seq", F.posexplode(values.truncate_array("fvalues", 10)).alias("pos", "x"))
    return rows.select("seq", (F.col("pos") + 1).alias("pos"), rounded("x", 6))


@query(
    "p7_p8_bucket_and_shape",
    """SELECT vec_id AS seq, (label & 255)::BIGINT AS part, 1 AS shape_kind, 1 AS report_kind FROM embeddings
UNION ALL SELECT event_id, user_id & 255, 0, 0 FROM events""",
)
def bucket_and_shape(spark, sf_dir):
    rows = waves(spark, sf_dir).select("seq", "series", "shape_dims").unionByName(events(spark, sf_dir).select("seq", "series", "shape_dims"))
    return rows.select(
        "seq", values.hash_bucket().alias("part"), values.shape_kind().alias("shape_kind"), values.shape_kind(most=2).alias("report_kind")
    )


@query(
    "p9_connection_status",
    """SELECT event_id AS seq, (event_id % 8)::INTEGER AS kind, ['ConnectError', 'ConnectTimeout', 'Established', 'Closing', 'ClosedUnexpected',
 'ConnectionHandlerDone'][event_id % 8] AS status FROM events WHERE event_id % 8 BETWEEN 1 AND 6""",
)
def connection_status(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), (F.col("event_id") % 8).cast("int").alias("kind"))
    return values.with_status_names(rows, values.connection_status_dim(spark))[0].select("seq", "kind", "status")


@query(
    "p10_channel_status",
    """WITH s AS (SELECT event_id AS seq, (event_id % 26)::INTEGER AS kind FROM events)
SELECT seq, kind, CASE WHEN kind = 1 THEN 'Opened' WHEN kind = 24 THEN 'AssignedToAddress' ELSE 'Closed' END AS status,
 CASE WHEN kind BETWEEN 2 AND 10 THEN ['ShutdownCommand', 'ChannelRemove', 'ProtocolError', 'FrequencyQuota', 'BandwidthQuota', 'InternalError',
  'IocTimeout', 'NoProtocol', 'ProtocolDone'][kind - 1] END AS reason FROM s WHERE kind BETWEEN 1 AND 10 OR kind = 24""",
)
def channel_status(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), (F.col("event_id") % 26).cast("int").alias("kind"))
    return values.with_status_names(rows, values.channel_status_dim(spark))[0].select("seq", "kind", "status", "reason")


@query("p10_unknown_status", "SELECT event_id AS seq FROM events WHERE NOT (event_id % 26 BETWEEN 1 AND 10 OR event_id % 26 = 24)")
def unknown_status(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), (F.col("event_id") % 26).cast("int").alias("kind"))
    return values.with_status_names(rows, values.channel_status_dim(spark))[1].select("seq")


@query("p14_iso_time", "SELECT event_id AS seq, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso FROM events")
def iso_time(spark, sf_dir):
    return events(spark, sf_dir).select("seq", times.iso_millis().alias("iso"))


@query(
    "p15_bool_bytes",
    """SELECT event_id AS seq, unnest([0, 1, 2, 3]) AS pos, unnest([(event_id >> 24) & 255 <> 0, (event_id >> 16) & 255 <> 0,
 (event_id >> 8) & 255 <> 0, event_id & 255 <> 0]) AS bit FROM events""",
)
def bool_bytes(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    bits = values.bool_bytes(big_endian(F.col("event_id"), 4))
    return rows.select(F.col("event_id").alias("seq"), F.posexplode(bits).alias("pos", "bit"))


@query(
    "p16_pulse_split",
    """SELECT event_id AS seq, (event_id * 977) >> 14 AS pulse_a, (event_id * 977) & 16383 AS pulse_b, epoch_ns(ts) // 1000000000 AS tsa,
 (epoch_ns(ts) % 1000000000)::BIGINT AS tsb FROM events""",
)
def pulse_split(spark, sf_dir):
    high, low = values.pulse_split(F.col("seq") * 977)
    sec, ns = times.second_and_nanos("ts_ns")
    return events(spark, sf_dir).select("seq", high.alias("pulse_a"), low.alias("pulse_b"), sec.alias("tsa"), ns.alias("tsb"))


@query("p20_terminated_string", "SELECT c.conv_id, c.turn, c.role AS name FROM conversations c")
def terminated_string(spark, sf_dir):
    padded = F.concat(F.col("role").cast("binary"), F.unhex(F.lit("00")), F.col("text").cast("binary"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", strip_terminator(padded).alias("name"))


@query(
    "p21_typed_access",
    "SELECT event_id AS seq, CASE WHEN event_type = 'view' THEN value END AS value, event_type <> 'view' AS mismatch FROM events",
)
def typed_access(spark, sf_dir):
    got = values.typed_value("value", "kind", "view")
    return events(spark, sf_dir).select("seq", got.alias("value"), got.isNull().alias("mismatch"))


# Reports.

ACTIVITY_SQL = f"""{ROLL_SQL},
a AS (SELECT ts_ns // {DAY} AS "window", series, 0 AS shape_kind, count(*) AS n, arg_max(msp, (ts_ns, seq)) AS last_msp,
  arg_max(ts_ns - msp, (ts_ns, seq)) AS last_lsp, arg_max(seq, (ts_ns, seq)) AS last_pulse FROM f GROUP BY ts_ns // {DAY}, series)"""


def daily_activity(spark, sf_dir):
    return reports.activity(rolled(spark, sf_dir), DAY)


@query("a2_activity", ACTIVITY_SQL + " SELECT * FROM a")
def activity(spark, sf_dir):
    return daily_activity(spark, sf_dir)


@query(
    "t1_most_active",
    ACTIVITY_SQL
    + """, r AS (SELECT *, (row_number() OVER (PARTITION BY "window", shape_kind ORDER BY n DESC, series))::INTEGER AS rank FROM a)
SELECT "window", shape_kind, rank, series, n FROM r WHERE rank <= 6""",
)
def most_active(spark, sf_dir):
    return reports.most_active(daily_activity(spark, sf_dir)).select("window", "shape_kind", "rank", "series", "n")


STATES = ["init", "wait_status_series", "unknown_address", "search_pending", "unassigned", "assigned", "no_address", "to_remove"]
STATE_SQL = f"""WITH s AS (SELECT user_id, {STATES}[arg_max(event_id, ts) % 8 + 1] AS state, arg_max(event_id, ts) % 3 = 0 AS did_send
  FROM events GROUP BY user_id)"""


def lifecycle_states(spark, sf_dir):
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_id", "ts").alias("n"))
    names = F.array(*[F.lit(s) for s in STATES])
    return last.select("user_id", F.element_at(names, (F.col("n") % 8 + 1).cast("int")).alias("state"), (F.col("n") % 3 == 0).alias("did_send"))


@query(
    "a3_state_counts",
    STATE_SQL + """ SELECT count(*) FILTER (WHERE state IN ('init', 'wait_status_series', 'unknown_address', 'to_remove')) AS unknown_address,
 count(*) FILTER (WHERE state IN ('unassigned', 'assigned')) AS with_address, count(*) FILTER (WHERE state = 'search_pending') AS search_pending,
 count(*) FILTER (WHERE state = 'no_address') AS no_address FROM s""",
)
def state_counts(spark, sf_dir):
    return reports.state_counts(lifecycle_states(spark, sf_dir))


@query(
    "a3_detailed_state_counts",
    STATE_SQL + """ SELECT count(*) FILTER (WHERE state = 'unknown_address') AS unknown_address, count(*) FILTER (WHERE state = 'search_pending') AS search_pending,
 count(*) FILTER (WHERE state = 'search_pending' AND did_send) AS search_sent, count(*) FILTER (WHERE state = 'no_address') AS no_address,
 count(*) FILTER (WHERE state = 'unassigned') AS unassigned, count(*) FILTER (WHERE state = 'assigned') AS assigned FROM s""",
)
def detailed_state_counts(spark, sf_dir):
    return reports.detailed_state_counts(lifecycle_states(spark, sf_dir))


END = 1_706_659_200 * SECOND


@query(
    "a4_liveness",
    f"""WITH l AS (SELECT user_id, max(epoch_ns(ts)) AS last FROM events GROUP BY user_id)
SELECT count(*) AS "all", count(*) FILTER (WHERE {END} - last < {DAY}) AS alive, count(*) FILTER (WHERE {END} - last >= {DAY}) AS not_alive FROM l""",
)
def liveness(spark, sf_dir):
    return reports.liveness(events(spark, sf_dir), END, DAY)


STATE_ROWS_SQL = interval_sql(0.05) + """, l AS (SELECT series, arg_max(seq, i) AS seq, arg_max(ema, i) AS ema, max(i) AS i, max(ts_ns) AS last, min(ts_ns) AS first
  FROM f GROUP BY series),
s AS (SELECT *, ['Init', 'Creating', 'FetchingSeriesId', 'Created', 'Created', 'Error', 'Ended'][seq % 7 + 1] AS state FROM l),
c AS (SELECT series AS channel, ['Disconnected', 'Connecting', 'Connecting', 'Connected', 'Connected', 'Error', 'Ended'][seq % 7 + 1] AS connected_info,
 CASE WHEN state = 'Created' THEN series END AS series, CASE WHEN state = 'Created' THEN 'F64' END AS scalar_type,
 CASE WHEN state = 'Created' THEN strftime(make_timestamp(first // 1000), '%Y-%m-%dT%H:%M:%S.%gZ') END AS ts_created,
 CASE WHEN state = 'Created' THEN strftime(make_timestamp(last // 1000), '%Y-%m-%dT%H:%M:%S.%gZ') END AS ts_event_last,
 CASE WHEN state = 'Created' AND i > 1 THEN ema END AS e FROM s)"""


def state_rows(spark, sf_dir):
    ema = statistics.interval_ema(events(spark, sf_dir))
    latest = F.max_by(F.struct("seq", "ema", "ema_count"), F.struct("ts_ns", "seq"))
    last = ema.groupBy("series").agg(latest.alias("_l"), F.max("ts_ns").alias("ts_ns"), F.min("ts_ns").alias("ts_created"))
    names = F.array(*[F.lit(s) for s in ("Init", "Creating", "FetchingSeriesId", "Created", "Created", "Error", "Ended")])
    return reports.channel_states(
        last.select(
            F.col("series").alias("channel"),
            F.lit("10.0.0.1:5064").alias("addr"),
            F.element_at(names, (F.col("_l.seq") % 7 + 1).cast("int")).alias("state"),
            "series",
            F.lit("F64").alias("scalar_type"),
            F.array().cast("array<int>").alias("shape_dims"),
            "ts_created",
            "ts_ns",
            "_l.ema",
            "_l.ema_count",
        )
    )


SHOW_STATES = """channel, connected_info, series, scalar_type, ts_created, ts_event_last, round(e, 4) + 0.0 AS recv_ivl_ema,
 round(1 / least(greatest(coalesce(e, 1e10), 1e-6), 1e10), 12) + 0.0 AS interest_score"""


def _show_states(states):
    return states.select(
        "channel", "connected_info", "series", "scalar_type", "ts_created", "ts_event_last",
        rounded("recv_ivl_ema", 4), rounded("interest_score", 12),
    )


@query("p12_p13_channel_states", STATE_ROWS_SQL + f" SELECT {SHOW_STATES} FROM c")
def channel_state_rows(spark, sf_dir):
    return _show_states(state_rows(spark, sf_dir))


@query("t3_state_listing", STATE_ROWS_SQL + f" SELECT {SHOW_STATES} FROM c ORDER BY channel LIMIT 40")
def state_listing(spark, sf_dir):
    return _show_states(reports.list_states(state_rows(spark, sf_dir)))


COUNTERS = """c AS (SELECT l_suppkey AS source, l_returnflag || l_linestatus AS name, sum(l_quantity)::BIGINT AS value FROM lineitem
  GROUP BY l_suppkey, l_returnflag || l_linestatus)"""


def counters(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy(F.col("l_suppkey").alias("source"), F.concat("l_returnflag", "l_linestatus").alias("name")).agg(
        F.sum("l_quantity").cast("long").alias("value")
    )


@query("a5_counter_sums", f"WITH {COUNTERS} SELECT name, sum(value)::BIGINT AS value, count(*) AS sources FROM c GROUP BY name")
def counter_sums(spark, sf_dir):
    return reports.sum_counters(counters(spark, sf_dir))


@query("k15_counter_lines", f"WITH {COUNTERS} SELECT 'plant_conn_' || name || ' ' || sum(value)::BIGINT AS value FROM c GROUP BY name")
def counter_lines(spark, sf_dir):
    return reports.counter_lines(reports.sum_counters(counters(spark, sf_dir)), "plant", "conn")


@query(
    "w11_counter_differences",
    """WITH c AS (SELECT l_suppkey AS source, l_returnflag AS name, epoch_ns(date_trunc('month', l_shipdate)) AS ts_ns, sum(l_quantity)::BIGINT AS value
  FROM lineitem GROUP BY ALL)
SELECT source, name, ts_ns, value - lag(value) OVER w AS diff, ts_ns - lag(ts_ns) OVER w AS dt_ns FROM c
WINDOW w AS (PARTITION BY source, name ORDER BY ts_ns) QUALIFY lag(value) OVER w IS NOT NULL""",
)
def counter_differences(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("month", F.date_trunc("month", F.col("l_shipdate").cast("timestamp")))
    snapshots = rows.groupBy(
        F.col("l_suppkey").alias("source"), F.col("l_returnflag").alias("name"), (F.unix_micros("month") * 1000).alias("ts_ns")
    ).agg(F.sum("l_quantity").cast("long").alias("value"))
    return reports.counter_differences(snapshots)

