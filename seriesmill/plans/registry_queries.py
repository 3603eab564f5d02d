"""Series registry, address history, lookups and search answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions.values import normal_address, socket_address
from seriesmill.operators import addresses, registry
from seriesmill.operators.slicing import SlicePolicy, number_rows
from seriesmill.plans.driver_tables import address_log, channel_requests, events, table
from seriesmill.plans.registered import query
from seriesmill.schemas import DAY, REGISTRY
from seriesmill.session import small_table

DIMS = "CASE WHEN event_type = 'click' THEN '[5, 3]' ELSE '[]' END"
REQUESTS = f"""r AS (SELECT event_id AS request_id, 'lab' AS backend, 'CH:' || user_id || ':' || event_type AS channel,
  CASE WHEN event_type = 'view' THEN 10 ELSE 9 END AS scalar_type, {DIMS} AS dims, user_id % 2 = 0 AS registered FROM events)"""


def ids_sql(keys: str) -> str:
    """Series ids of distinct keys: the first salt with a valid number."""
    return f"""ks AS ({keys}),
c AS (SELECT *, unnest(range(64)) AS salt FROM ks),
h AS (SELECT *, md5(concat_ws('|', backend, channel, scalar_type, dims, salt)) AS m FROM c),
x AS (SELECT *, ('0x' || m[15:16] || m[13:14] || m[11:12] || m[9:10] || m[7:8] || m[5:6] || m[3:4] || m[1:2])::UBIGINT AS id FROM h),
ids AS (SELECT backend, channel, scalar_type, dims, arg_min(id, salt)::BIGINT AS series FROM x
  WHERE id BETWEEN 100000000000000000 AND 9223372036854775807 GROUP BY backend, channel, scalar_type, dims)"""


ALL_IDS = ids_sql("SELECT DISTINCT backend, channel, scalar_type, dims FROM r")


def requests(spark, sf_dir):
    return channel_requests(spark, sf_dir)


def dims():
    return registry.dims_text().alias("dims")


def half_registered(spark, sf_dir):
    """A registry that already holds the channels of users with an even number."""
    keys = requests(spark, sf_dir).filter("cast(split(channel, ':')[1] as bigint) % 2 = 0")
    return registry.assign_ids(keys.select(*registry.KEY).distinct(), no_registry(spark))


def no_registry(spark):
    return small_table(spark, [], REGISTRY)


@query("r1_series_ids", f"WITH {REQUESTS}, {ALL_IDS} SELECT backend, channel, scalar_type, dims, series FROM ids")
def series_ids(spark, sf_dir):
    keys = requests(spark, sf_dir).select(*registry.KEY).distinct()
    ids = registry.assign_ids(keys, no_registry(spark))
    return ids.select("backend", "channel", "scalar_type", dims(), "series")


@query(
    "r2_get_or_create",
    f"""WITH {REQUESTS}, {ALL_IDS}
SELECT request_id, series, NOT registered AS is_new FROM r JOIN ids USING (backend, channel, scalar_type, dims)""",
)
def get_or_create(spark, sf_dir):
    answered, _ = registry.get_or_create(requests(spark, sf_dir), half_registered(spark, sf_dir))
    return answered.select("request_id", "series", "is_new")


STATUS_IDS = ids_sql("SELECT DISTINCT 'lab' AS backend, 'CH:' || user_id AS channel, -2147483647 AS scalar_type, '[]' AS dims FROM events")


@query("r3_status_series", f"WITH {STATUS_IDS} SELECT channel, scalar_type, series FROM ids")
def status_series(spark, sf_dir):
    channels = table(spark, sf_dir, "events").select(
        F.lit("lab").alias("backend"), F.concat(F.lit("CH:"), F.col("user_id").cast("string")).alias("channel")
    )
    ids, _ = registry.get_or_create(registry.status_requests(channels), no_registry(spark))
    return ids.select("channel", "scalar_type", "series")


@query(
    "j1_registry_lookup",
    f"""WITH {REQUESTS}, {ALL_IDS} SELECT request_id, CASE WHEN registered THEN series END AS series
FROM r JOIN ids USING (backend, channel, scalar_type, dims)""",
)
def registry_lookup(spark, sf_dir):
    return registry.lookup(requests(spark, sf_dir), half_registered(spark, sf_dir)).select("request_id", "series")


@query("j2_missing_requests", f"WITH {REQUESTS} SELECT DISTINCT channel, scalar_type, dims FROM r WHERE NOT registered")
def missing_requests(spark, sf_dir):
    return registry.missing(requests(spark, sf_dir), half_registered(spark, sf_dir)).select("channel", "scalar_type", dims())


@query(
    "u2_append_absent",
    f"WITH {REQUESTS}, {ALL_IDS} SELECT channel, scalar_type, dims, series FROM ids",
)
def append_absent(spark, sf_dir):
    """Append the ids of every channel to a registry that has half of them."""
    have = half_registered(spark, sf_dir)
    _, created = registry.get_or_create(requests(spark, sf_dir), have)
    twice = created.unionByName(created).unionByName(have)
    return registry.append_absent(have, twice).select("channel", "scalar_type", dims(), "series")


@query("s11_series_of_channel", f"WITH {REQUESTS}, {ALL_IDS} SELECT series, scalar_type, dims FROM ids WHERE channel = 'CH:8:click'")
def series_of_channel(spark, sf_dir):
    keys = requests(spark, sf_dir).select(*registry.KEY).distinct()
    ids = registry.assign_ids(keys, no_registry(spark))
    return registry.series_of_channel(ids, "lab", "CH:8:click").select("series", "scalar_type", dims())


@query(
    "t2_ordered_requests",
    f"""WITH {REQUESTS}, {ALL_IDS} SELECT request_id, series, row_number() OVER (ORDER BY request_id) - 1 AS place
FROM r JOIN ids USING (backend, channel, scalar_type, dims) WHERE registered""",
)
def ordered_requests(spark, sf_dir):
    """Found requests in request order, numbered by ranges."""
    found = registry.lookup(requests(spark, sf_dir), half_registered(spark, sf_dir)).filter("series is not null")
    return number_rows(found.select("request_id", "series"), ["request_id"], "place").orderBy("request_id")


# Address history.

LOG = """l AS (SELECT user_id AS channel, CASE WHEN event_type <> 'error' THEN event_type END AS addr,
  event_type || ':' || event_id AS responseaddr, epoch_ns(ts) AS tsmod, event_id AS seq FROM events)"""
HISTORY = f"""WITH {LOG},
a AS (SELECT *, row_number() OVER w AS i, lag(addr) OVER w AS before, lag(seq) OVER w IS NULL AS first FROM l
  WINDOW w AS (PARTITION BY channel ORDER BY tsmod, seq)),
b AS (SELECT *, sum(CASE WHEN first OR addr IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY i)::BIGINT AS run FROM a),
h AS (SELECT channel, run, any_value(addr) AS addr, arg_max(responseaddr, i) AS responseaddr, min(tsmod) AS tscreate, max(tsmod) AS tsmod
  FROM b GROUP BY channel, run)
SELECT *, CASE WHEN run = max(run) OVER (PARTITION BY channel) THEN 0 ELSE 1 END AS archived FROM h"""


@query("w13_address_history", HISTORY)
def address_history(spark, sf_dir):
    return addresses.address_history(address_log(spark, sf_dir)).drop("facility")


@query("w13_address_history_sliced", HISTORY)
def address_history_sliced(spark, sf_dir):
    return addresses.address_history(address_log(spark, sf_dir), policy=SlicePolicy(max_rows=50)).drop("facility")


@query("w13_address_history_extended", HISTORY)
def address_history_extended(spark, sf_dir):
    """The history built from the first half of the month, then extended by the second."""
    log = address_log(spark, sf_dir)
    middle = 1_705_276_800 * 1_000_000_000
    before = addresses.address_history(log.filter(F.col("tsmod") < middle))
    changed = addresses.extend_history(before, log.filter(F.col("tsmod") >= middle))
    kept = before.join(changed.select("facility", "channel", "run"), ["facility", "channel", "run"], "left_anti")
    return kept.unionByName(changed).drop("facility")


@query("w13_late_rows", HISTORY)
def address_history_late(spark, sf_dir):
    """The history of every second log row, then updated by those between them."""
    log = address_log(spark, sf_dir)
    before = addresses.address_history(log.filter("seq % 2 = 1"))
    return addresses.update_history(before, log.filter("seq % 2 = 0"), log).drop("facility")


@query(
    "a1_latest_address",
    f"WITH {LOG} SELECT channel, arg_max(addr, (tsmod, seq)) AS addr, max(tsmod) AS tsmod FROM l WHERE addr IS NOT NULL GROUP BY channel",
)
def latest_address(spark, sf_dir):
    return addresses.latest_addresses(address_log(spark, sf_dir)).drop("facility")


@query("t4_latest_of_channel", f"WITH {LOG} SELECT channel, addr, tsmod FROM l WHERE channel = 8 AND addr IS NOT NULL ORDER BY tsmod DESC, seq DESC LIMIT 1")
def latest_of_channel(spark, sf_dir):
    return addresses.latest_address(address_log(spark, sf_dir), "lab", 8).drop("facility")


FIND = f"""WITH {LOG}, q AS (SELECT c_custkey AS channel FROM customer),
f AS (SELECT channel, arg_max(addr, (tsmod, seq)) AS addr FROM l WHERE addr IS NOT NULL GROUP BY channel)"""


def asked_channels(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.lit("lab").alias("facility"), F.col("c_custkey").alias("channel"))


@query("j3_find_addresses", FIND + " SELECT q.channel, f.addr FROM q LEFT JOIN f ON q.channel = f.channel")
def find_addresses(spark, sf_dir):
    found = addresses.find_addresses(asked_channels(spark, sf_dir), address_log(spark, sf_dir))
    return found.select("channel", "addr")


@query(
    "u1_all_answered",
    FIND + " SELECT (SELECT count(*) FROM q) AS asked, (SELECT count(*) FROM q LEFT JOIN f ON q.channel = f.channel) AS answered, true AS complete",
)
def all_answered(spark, sf_dir):
    asked = asked_channels(spark, sf_dir)
    return addresses.all_answered(asked, addresses.find_addresses(asked, address_log(spark, sf_dir)))


@query(
    "j4_null_safe_match",
    f"""WITH {LOG}, c AS (SELECT channel, arg_max(struct_pack(a := addr), (tsmod, seq)).a AS addr FROM l GROUP BY channel)
SELECT l.channel, l.seq FROM l JOIN c ON l.channel = c.channel AND l.addr IS NOT DISTINCT FROM c.addr""",
)
def null_safe_match(spark, sf_dir):
    log = address_log(spark, sf_dir)
    current = addresses.address_history(log).filter("archived = 0").select("facility", "channel", "addr")
    return addresses.match_addresses(log, current).select("channel", "seq")


@query(
    "f3_gateway_filter",
    """WITH g AS (SELECT n_nationkey AS gateway FROM nation WHERE n_regionkey = 1),
s AS (SELECT s_suppkey, s_nationkey AS addr, CASE WHEN s_suppkey % 3 > 0 THEN (s_nationkey + 1) % 25 END AS response_addr FROM supplier)
SELECT s_suppkey, addr, response_addr FROM s
WHERE NOT EXISTS (SELECT 1 FROM g WHERE gateway = addr) AND NOT EXISTS (SELECT 1 FROM g WHERE gateway = response_addr)""",
)
def gateway_filter(spark, sf_dir):
    found = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").alias("addr"),
        F.when(F.col("s_suppkey") % 3 > 0, (F.col("s_nationkey") + 1) % 25).alias("response_addr"),
    )
    gateways = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("gateway"))
    return addresses.drop_gateways(found, gateways)


SEARCH = """e AS (SELECT user_id AS channel, epoch_ns(ts) AS ts_ns, event_id AS seq, event_type FROM events)"""


def searches(spark, sf_dir):
    rows = events(spark, sf_dir).withColumnRenamed("series", "channel")
    asked = rows.filter("kind = 'signup'").select("channel", "ts_ns", "seq")
    answered = rows.filter("kind = 'purchase'").select(
        "channel", "ts_ns", "seq", F.concat(F.lit("r"), F.col("seq").cast("string")).alias("response_addr"),
        F.concat(F.lit("a"), F.col("seq").cast("string")).alias("addr"),
    )
    return asked, answered


MATCH_SQL = f"""WITH {SEARCH}, q AS (SELECT * FROM e WHERE event_type = 'signup'), a AS (SELECT * FROM e WHERE event_type = 'purchase'),
m AS (SELECT q.channel, q.ts_ns, q.seq, min(a.ts_ns) AS hit, arg_min(a.seq, (a.ts_ns, a.seq)) AS answer
  FROM q LEFT JOIN a ON a.channel = q.channel AND a.ts_ns BETWEEN q.ts_ns AND q.ts_ns + {DAY} GROUP BY q.channel, q.ts_ns, q.seq)
SELECT channel, ts_ns, seq, 'r' || answer AS response_addr, 'a' || answer AS addr, coalesce(hit - ts_ns, {DAY}) AS dt, hit IS NOT NULL AS answered FROM m"""


@query("j6_match_answers", MATCH_SQL)
def match_answers(spark, sf_dir):
    return addresses.match_answers(*searches(spark, sf_dir), ("channel",), DAY)


@query("j6_match_answers_sliced", MATCH_SQL)
def match_answers_sliced(spark, sf_dir):
    return addresses.match_answers(*searches(spark, sf_dir), ("channel",), DAY, policy=SlicePolicy(max_rows=15))


@query(
    "j6_duplicate_answers",
    f"""WITH {SEARCH}, o AS (SELECT channel, event_type, lag(event_type) OVER (PARTITION BY channel ORDER BY ts_ns, seq) AS before
  FROM e WHERE event_type IN ('signup', 'purchase'))
SELECT channel, count(*) FILTER (WHERE event_type = 'purchase' AND before = 'purchase') AS duplicates FROM o GROUP BY channel""",
)
def duplicate_answers(spark, sf_dir):
    return addresses.duplicate_answers(*searches(spark, sf_dir), ("channel",))


HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query(
    "p19_normal_address",
    f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN {HOST} || ':5064' WHEN 1 THEN {HOST} || ':' || page_id WHEN 2 THEN NULL
  ELSE '10.0.' || page_id % 256 || '.7:5064' END AS addr,
 CASE WHEN page_id % 4 = 3 THEN '10.0.' || page_id % 256 || '.7:5064' END AS parsed FROM pages""",
)
def normal_addresses(spark, sf_dir):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    n = F.col("page_id")
    text = (
        F.when(n % 4 == 0, host)
        .when(n % 4 == 1, F.concat(host, F.lit(":"), n.cast("string")))
        .when(n % 4 == 2, F.lit("  "))
        .otherwise(F.concat(F.lit("10.0."), (n % 256).cast("string"), F.lit(".7")))
    )
    pages = table(spark, sf_dir, "pages").select("page_id", normal_address(text).alias("addr"))
    return pages.withColumn("parsed", socket_address("addr"))
