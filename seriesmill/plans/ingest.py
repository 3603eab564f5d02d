"""The ways from a source to the archive, put together from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.times import bucket, utc_date
from seriesmill.operators import addresses, bins, layout, registry
from seriesmill.operators.fold import fold
from seriesmill.operators.joins import join_sized
from seriesmill.operators.kernels import IntervalGate, PartitionRoll
from seriesmill.operators.layout import last_write_wins
from seriesmill.operators.slicing import DEFAULT_POLICY, SlicePolicy
from seriesmill.schemas import MINUTE, REGISTRY, SCALAR_TYPE_CODES, SECOND
from seriesmill.session import cut_lineage, small_table
from seriesmill.sinks import tables
from seriesmill.sources import captures, device_events


@dataclass
class Ingested:
    """What a batch adds to the registry, and what it set aside."""

    created: DataFrame
    rejected: DataFrame


def type_code(scalar_type: Column | str = "scalar_type") -> Column:
    """Number of a scalar type in the registry."""
    codes = F.create_map(*[F.lit(x) for pair in SCALAR_TYPE_CODES.items() for x in pair])
    return F.try_element_at(codes, F.col(scalar_type) if isinstance(scalar_type, str) else scalar_type)


def typed_columns(decoded: DataFrame) -> DataFrame:
    """Decoded elements in the typed columns of the event table."""
    first = lambda c: F.try_element_at(c, F.lit(1))
    scalar = F.size("shape_dims") == 0
    have = set(decoded.columns)
    wide = first("wide").cast("string") if "wide" in have else F.lit(None).cast("string")
    texts = F.col("texts") if "texts" in have else F.lit(None).cast("array<string>")
    wide_texts = F.col("wide").cast("array<string>") if "wide" in have else F.lit(None).cast("array<string>")
    flag = F.col("scalar_type") == "BOOL"
    return decoded.withColumns(
        {
            "ivalue": F.when(scalar & ~flag, first("ints")),
            "bvalue": F.when(scalar & flag, first("ints") != 0),
            "fvalue": F.when(scalar, first("floats")),
            "svalue": F.when(scalar, F.coalesce("text", wide)),
            "ivalues": F.when(~scalar & ~flag, F.col("ints")),
            "bvalues": F.when(~scalar & flag, F.transform("ints", lambda x: x != 0)),
            "fvalues": F.when(~scalar, F.col("floats")),
            "svalues": F.when(~scalar, F.coalesce(texts, wide_texts)),
        }
    )


def with_series(rows: DataFrame, known: DataFrame, backend: str) -> tuple[DataFrame, DataFrame]:
    """Add the series of every row's channel, type and shape; also gives new registry rows."""
    asked = rows.withColumn("backend", F.lit(backend)).withColumn("_name", F.col("scalar_type")).withColumn("scalar_type", type_code())
    answered, created = registry.get_or_create(asked, known)
    return answered.withColumn("scalar_type", F.col("_name")).drop("_name", "backend", "is_new"), created


def ingest_captures(
    messages: DataFrame,
    known: DataFrame,
    backend: str,
    root: str,
    batch_id: int,
    roll: PartitionRoll | None = None,
    most_channels: int | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> Ingested:
    """Captured messages to stored events: headers, frames, values, series, layout, tables."""
    good, bad = captures.decode_headers(messages)
    frames, unread = captures.channel_frames(good, most_channels)
    values = typed_columns(captures.decode_frames(frames)).withColumn("seq", F.col("msg_id"))
    # decoded once: the registry and the layout read them several times
    values = cut_lineage(values.select("channel", *[c for c in values.columns if c in tables.TABLES["events"].columns.names]))
    rows, created = with_series(values, known, backend)
    laid_out = layout.lay_out(rows.drop("channel"), roll or PartitionRoll(max_rows=6400), policy=policy)
    tables.write_events(laid_out, root, batch_id)
    rejected = bad.select("msg_id", "reason").unionByName(unread.select("msg_id", "reason"))
    return Ingested(created, rejected)


def events_since(every: DataFrame, touched: DataFrame, patch_ns: int, max_carry_ns: int) -> DataFrame:
    """Stored events of the touched series that can reach into their patches from `_first` on.

    The earliest time and the range of series are read from `touched` first, so that the scan
    opens only the days from there on and skips the row groups of other series. A late row makes its
    batch read from its day on: the gap after its series' last old event ends at any later one.
    """
    lowest = touched.agg(F.min("_first"), F.min("series"), F.max("series")).first()
    if lowest[0] is None:
        return every.filter(F.lit(False))
    since = F.lit(lowest[0] * patch_ns - max_carry_ns)
    near = every.filter((F.col("date") >= utc_date(since)) & (F.col("ts_ns") >= since) & F.col("series").between(lowest[1], lowest[2]))
    seen = join_sized(near, touched, ["series"], "inner").filter(F.col("ts_ns") >= F.col("_first") * patch_ns - max_carry_ns)
    return seen.drop("_first", "_last")


def update_patches(
    spark: SparkSession,
    root: str,
    batch_id: int,
    bin_ns: int,
    bin_count: int,
    max_carry_ns: int,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> None:
    """Write the bin patches that a stored batch of events touches, made from all stored events.

    An event can change bins from `max_carry_ns` before it, where the value before it ended, to
    `max_carry_ns` after it. Those patches are made anew from the events of the batch's series from
    there on, whichever batch brought them, and replace the earlier ones when read with
    `current_patches`: however the events are split into batches, the patches are those of one.
    """
    every = bins.binnable(tables.read(spark, root, "events_scalar"))
    new = every.filter(F.col("batch") == batch_id)
    patch_ns = bin_ns * bin_count
    touched = new.groupBy("series").agg(
        bucket(F.min("ts_ns") - max_carry_ns, patch_ns).alias("_first"), bucket(F.max("ts_ns") + max_carry_ns, patch_ns).alias("_last")
    )
    touched = cut_lineage(touched)
    numeric = last_write_wins(events_since(every, touched, patch_ns, max_carry_ns), tables.TABLES["events_scalar"].key, ("batch", "seq"))
    numeric = numeric.withColumn("value", F.coalesce("fvalue", F.col("ivalue").cast("double")))
    binned = bins.time_weighted_bins(numeric, bin_ns, single_precision=True, max_carry_ns=max_carry_ns, policy=policy)
    patches = bins.bin_patches(binned, bin_ns, bin_count).join(touched, "series")
    off = F.col("off_msp") * 1000 + F.col("off_lsp")
    tables.write(patches.filter(off.between(F.col("_first"), F.col("_last"))), root, "binned_scalar_f32", batch_id)


def current_patches(spark: SparkSession, root: str) -> DataFrame:
    """Bin patches as the last batch that touched them left them."""
    return last_write_wins(tables.read(spark, root, "binned_scalar_f32"), tables.TABLES["binned_scalar_f32"].key, ("batch",))


def ingest_device_events(
    frames: DataFrame,
    subscriptions: DataFrame,
    known: DataFrame,
    backend: str,
    root: str,
    batch_id: int,
    max_carry_ns: int,
    gate: IntervalGate | None = None,
    bin_ns: int = MINUTE,
    bin_count: int = 60,
    array_truncate: int | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> Ingested:
    """Captured device frames to stored events, interval reports and bin patches.

    `subscriptions` names the channel of every `subid`. Only admitted events are stored and binned;
    the gate runs on the time of arrival, so that late events pass it like others. Bins are
    made from what all batches have stored (see `update_patches`).
    """
    good, bad = device_events.decode_events(frames, array_truncate)
    named = join_sized(good, subscriptions.select("subid", "channel"), ["subid"], "inner")
    values = typed_columns(named)
    timed, untimed = values.filter("ts_ns is not null"), values.filter("ts_ns is null")
    rows, created = with_series(timed.withColumn("pulse", F.lit(0).cast("long")), known, backend)
    gate = gate or IntervalGate(ts="recv_ts_ns")
    gated = cut_lineage(fold(rows, ["series"], gate, order=(gate.ts, "seq"), policy=policy))
    tables.write_events(layout.lay_out(gated.filter("admitted"), policy=policy), root, batch_id)
    reports = gated.filter("report").withColumn("ema", F.col("report_ema")).withColumn("emd", F.col("report_emd"))
    tables.write(tables.with_part(reports), root, "receive_interval", batch_id)
    update_patches(rows.sparkSession, root, batch_id, bin_ns, bin_count, max_carry_ns, policy)
    rejected = bad.select("seq", "reason").unionByName(untimed.select("seq", F.lit("no time").alias("reason")))
    return Ingested(created, rejected)


def update_addresses(
    requests: DataFrame,
    answers: DataFrame,
    gateways: DataFrame,
    history: DataFrame,
    facility: str,
    limit_ns: int = SECOND * 8 // 10,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Search requests and answers to changed runs of the address history."""
    found = addresses.match_answers(requests, answers, ("channel",), limit_ns, policy=policy)
    direct = addresses.drop_gateways(found, gateways)
    log = direct.select(
        F.lit(facility).alias("facility"),
        "channel",
        "addr",
        F.col("response_addr").alias("responseaddr"),
        (F.col("ts_ns") + F.col("dt")).alias("tsmod"),
        "seq",
    )
    return addresses.extend_history(history, log, policy=policy)


def empty_registry(spark: SparkSession) -> DataFrame:
    return small_table(spark, [], REGISTRY)
