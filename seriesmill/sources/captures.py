"""Captured multi-frame messages: headers, channel descriptors and typed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.binary import decode_values, strip_terminator
from seriesmill.functions.times import global_time_ns
from seriesmill.functions.values import bool_bytes, pulse_id
from seriesmill.operators.quality import (
    frame_count_ok,
    header_hash_ok,
    pulse_matches_time,
    pulse_out_of_range,
    within_limit,
)
from seriesmill.schemas import CAPTURE, DATA_HEADER, MAIN_HEADER

# Scalar types by their name in a data header.
HEADER_TYPES = {
    "bool": "BOOL", "string": "STRING", "float32": "F32", "float64": "F64", "float": "F64",
    "int8": "I8", "int16": "I16", "int32": "I32", "int64": "I64",
    "uint8": "U8", "uint16": "U16", "uint32": "U32", "uint64": "U64",
}

# Compression names; the codecs are not available, so such rows are set aside.
CODECS = ("lz4", "bitshuffle_lz4")

def read_captures(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(CAPTURE).options(**options).parquet(path)


def decode_headers(captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with both headers, and the rejected ones with a reason."""
    headers = F.struct(
        F.from_json(F.try_element_at("frames", F.lit(1)).cast("string"), MAIN_HEADER).alias("_main"),
        F.from_json(F.try_element_at("frames", F.lit(2)).cast("string"), DATA_HEADER).alias("_dh"),
        F.md5(F.try_element_at("frames", F.lit(2))).alias("header_md5"),
    )
    # a generator is not merged into later projections, so each header is parsed once
    parsed = captures.select("*", F.inline(F.array(headers)))
    reason = (
        F.when(F.size("frames") < 2, "too few frames")
        .when(F.col("_main.hash").isNull(), "bad main header")
        .when(F.col("_main.dh_compression").isin(*CODECS), "compressed data header")
        .when(F.col("_dh.channels").isNull(), "bad data header")
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.filter("reason is null").select(
        *captures.columns,
        "header_md5",
        F.col("_main.htype").alias("htype"),
        F.col("_main.hash").alias("hash"),
        pulse_id("_main.pulse_id").alias("pulse"),
        global_time_ns("_main.global_timestamp.sec", "_main.global_timestamp.ns").alias("ts_ns"),
        F.col("_dh.channels").alias("channels"),
    )
    return good, judged.filter("reason is not null").select(*captures.columns, "reason")


def with_quality(messages: DataFrame) -> DataFrame:
    """Add the checks of a message as boolean columns."""
    return (
        messages.withColumn("frames_ok", frame_count_ok())
        .withColumn("hash_ok", header_hash_ok())
        .withColumn("pulse_out_of_range", pulse_out_of_range())
        .withColumn("pulse_matches_time", pulse_matches_time())
    )


def channel_frames(messages: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One row per channel of a message with its value and timestamp frames, and the rejected rows.

    With a limit, the channels of a message beyond the first `most` are among the rejected.
    """
    carried = [c for c in messages.columns if c not in ("frames", "channels")]
    # Each channel gets its own two frames before the explode; no row carries all frames of the message.
    with_frames = F.transform(
        "channels",
        lambda desc, i: F.struct(
            i.alias("pos"),
            desc.alias("_desc"),
            F.try_element_at("frames", i * 2 + 3).alias("payload"),
            F.try_element_at("frames", i * 2 + 4).alias("ts_payload"),
        ),
    )
    rows = messages.select(*carried, F.inline(with_frames))
    kind = F.coalesce(F.col("_desc.type"), F.lit("float64"))
    types = F.create_map(*[F.lit(x) for pair in HEADER_TYPES.items() for x in pair])
    named = F.try_element_at(types, kind)
    compression = F.nullif(F.col("_desc.compression"), F.lit("none"))
    rows = rows.select(
        *carried,
        "pos",
        F.col("_desc.name").alias("channel"),
        named.alias("scalar_type"),
        F.coalesce("_desc.shape", F.array().cast("array<int>")).alias("shape_dims"),
        F.coalesce(F.col("_desc.encoding") == "big", F.lit(False)).alias("big_endian"),
        compression.alias("compression"),
        "payload",
        "ts_payload",
    )
    reason = (
        F.when(~within_limit(most=most), "beyond the channel limit")
        .when(F.col("scalar_type").isNull(), "unknown type")
        .when(F.col("compression").isin(*CODECS), "compressed value")
        .when(F.col("compression").isNotNull(), "unknown compression")
        .when(F.col("payload").isNull(), "message too short")
    )
    judged = rows.withColumn("reason", reason)
    return judged.filter("reason is null").drop("reason", "compression"), judged.filter("reason is not null")


def decode_frames(frames: DataFrame) -> DataFrame:
    """Typed values: element arrays `ints`, `wide` (u64) or `floats`, and `text` for strings."""
    value = decode_values("payload", "scalar_type", "big_endian")
    text = F.when(F.col("scalar_type") == "STRING", strip_terminator("payload"))
    rows = frames.withColumn("_v", value)
    rest = [c for c in frames.columns if c not in ("payload", "big_endian")]
    return rows.select(*rest, "_v.ints", "_v.wide", "_v.floats", text.alias("text"))


def pulse_map(frames: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pulse numbers, sent as big-endian doubles by the named channels, with the message time."""
    rows = frames.filter(F.col("channel").isin(*names) & (F.octet_length("payload") == 8))
    value = decode_values("payload", F.lit("F64"), F.lit(True))
    return rows.select(F.element_at(value["floats"], 1).cast("long").alias("pulse"), "ts_ns")


def event_bits(frames: DataFrame, name: str) -> DataFrame:
    """Booleans of a channel that sends one byte per event."""
    return frames.filter(F.col("channel") == name).select("ts_ns", "pulse", bool_bytes("payload").alias("bits"))


def frame_times(frames: DataFrame) -> DataFrame:
    """Add `frame_ts_ns`: two big-endian numbers, seconds and nanoseconds, in the timestamp frame."""
    whole = F.octet_length("ts_payload") == 16
    part = decode_values("ts_payload", F.lit("U64"), F.lit(True))["wide"]
    ts = F.element_at(part, 1).cast("long") * 1_000_000_000 + F.element_at(part, 2).cast("long")
    return frames.withColumn("frame_ts_ns", F.when(whole, ts))

