"""The driver's tables in the roles of this library's inputs.

Their timestamps have no zone and are read as UTC, the session zone the library asks for.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.schemas import BINARY
from seriesmill.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nanos(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp")) * 1000


def as_events(rows: DataFrame, by: str = "user_id") -> DataFrame:
    """Rows of the events table as channel events; the series is one of its columns."""
    return rows.select(
        F.col(by).alias("series"),
        nanos("ts").alias("ts_ns"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("pulse"),
        F.lit("F64").alias("scalar_type"),
        F.array().cast("array<int>").alias("shape_dims"),
        "value",
        F.col("event_type").alias("kind"),
    )


def events(spark: SparkSession, sf_dir: str, by: str = "user_id") -> DataFrame:
    return as_events(table(spark, sf_dir, "events"), by)


def waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as waveform events of one series per label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("long").alias("series"),
        (F.col("vec_id") * 1_000_000_000).alias("ts_ns"),
        F.col("vec_id").alias("seq"),
        F.col("vec_id").alias("pulse"),
        F.lit("F32").alias("scalar_type"),
        F.array(F.size("embedding")).alias("shape_dims"),
        F.col("embedding").cast("array<double>").alias("fvalues"),
    )


def address_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as channels, event types as addresses; an error is a search without answer."""
    return table(spark, sf_dir, "events").select(
        F.lit("lab").alias("facility"),
        F.col("user_id").alias("channel"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("addr"),
        F.concat(F.col("event_type"), F.lit(":"), F.col("event_id").cast("string")).alias("responseaddr"),
        nanos("ts").alias("tsmod"),
        F.col("event_id").alias("seq"),
    )


def channel_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event for the channel of its user and event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.lit("lab").alias("backend"),
        F.concat(F.lit("CH:"), F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")).alias("channel"),
        F.when(F.col("event_type") == "view", 10).otherwise(9).cast("int").alias("scalar_type"),
        F.when(F.col("event_type") == "click", F.array(F.lit(5), F.lit(3)))
        .otherwise(F.array().cast("array<int>"))
        .alias("shape_dims"),
    )


def big_endian(number: Column, size: int) -> Column:
    """A non-negative integer as bytes, highest first."""
    return F.unhex(F.lpad(F.hex(number.cast("long")), 2 * size, "0"))


def little_endian(number: Column, size: int) -> Column:
    hexed = F.lpad(F.hex(number.cast("long")), 2 * size, "0")
    return F.unhex(F.concat(*[F.substring(hexed, 2 * i + 1, 2) for i in reversed(range(size))]))


@F.arrow_udf(BINARY)
def double_bytes(values: pa.Array) -> pa.Array:
    """Big-endian bytes of doubles."""
    raw = np.asarray(values, dtype=np.float64).astype(">f8").tobytes()
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(values), [None, pa.py_buffer(raw)])
    return fixed.cast(pa.binary())


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured message per event: a double, an integer in little-endian order and a text.

    Users are sources. Some messages lack a frame, carry a wrong hash, or a header of another
    channel count, by rules on the event number.
    """
    rows = table(spark, sf_dir, "events").withColumn("ts_ns", nanos("ts"))
    n = F.col("event_id")
    extra = F.when(n % 7 == 0, F.lit(',{"name":"note","type":"string"}')).otherwise(F.lit(""))
    header = F.concat(
        F.lit('{"htype":"bsr_d-1.1","channels":[{"name":"value","encoding":"big"},'),
        F.lit('{"name":"count","type":"int32","shape":[],"compression":"none"}'),
        extra,
        F.lit("]}"),
    )
    rows = rows.withColumn("_dh", header)
    digest = F.when(n % 11 == 0, F.lit("0" * 32)).otherwise(F.md5("_dh"))
    main = F.concat(
        F.lit('{"htype":"bsr_m-1.1","pulse_id":'),
        (n + 14_780_999_000).cast("string"),
        F.lit(',"hash":"'),
        digest,
        F.lit('","global_timestamp":{"sec":'),
        F.expr("ts_ns div 1000000000").cast("string"),
        F.lit(',"ns":'),
        F.expr("ts_ns % 1000000000").cast("string"),
        F.lit("}"),
        F.when(n % 13 == 0, F.lit(',"dh_compression":"lz4"}')).otherwise(F.lit("}")),
    )
    stamp = F.concat(big_endian(F.expr("ts_ns div 1000000000"), 8), big_endian(F.expr("ts_ns % 1000000000"), 8))
    value = [double_bytes("value"), stamp]
    count = [little_endian(n, 4), stamp]
    note = [F.col("event_type").cast("binary"), stamp]
    bare = F.array(main.cast("binary"), F.col("_dh").cast("binary"), *value, *count)
    noted = F.array(main.cast("binary"), F.col("_dh").cast("binary"), *value, *count, *note)
    frames = F.when(n % 17 == 0, F.array(main.cast("binary"))).when(n % 7 == 0, noted).otherwise(bare)
    return rows.select(
        n.alias("msg_id"), F.col("user_id").cast("string").alias("source"), F.col("ts_ns").alias("recv_ts_ns"), frames.alias("frames")
    )


def device_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured device frame per event, its type chosen by the event number."""
    rows = table(spark, sf_dir, "events").withColumn("ts_ns", nanos("ts"))
    n = F.col("event_id")
    secs = F.expr("ts_ns div 1000000000 - 631152000")
    head = F.concat(big_endian(n % 3, 2), big_endian(n % 4, 2), big_endian(secs, 4), big_endian(F.expr("ts_ns % 1000000000"), 4))
    pad = lambda k: F.unhex(F.lit("00" * k))
    text = F.concat(F.col("event_type").cast("binary"), pad(3))
    code = (n % 8).cast("int")
    body = (
        F.when(code == 0, text)
        .when(code == 1, F.concat(pad(2), big_endian(n % 30000, 2)))
        .when(code == 2, F.concat(pad(2), big_endian(n % 100, 2)))
        .when(code == 3, F.concat(pad(3), big_endian(n % 100, 1), pad(4)))
        .when(code == 4, big_endian(n, 4))
        .when(code == 5, F.concat(pad(4), double_bytes("value")))
        .when(code == 6, F.concat(big_endian(n, 4), big_endian(n + 1, 4), big_endian(n + 2, 4)))
        .otherwise(big_endian(n, 2))
    )
    type_id = F.element_at(F.array(*[F.lit(t) for t in (14, 15, 17, 18, 19, 20, 19, 5)]), code + 1)
    return rows.select(
        n.alias("seq"),
        F.col("ts_ns").alias("recv_ts_ns"),
        F.lit(1).alias("cmdid"),
        type_id.alias("data_type"),
        F.when(code == 6, 3).otherwise(1).alias("data_count"),
        F.lit(1).cast("long").alias("param1"),
        F.col("user_id").alias("param2"),
        F.concat(head, body).alias("payload"),
    )


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which every executor can reach."""
    return f"{ensure_checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"
