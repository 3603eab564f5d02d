"""Captured device event frames: time metadata and typed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.binary import decode_values, fixed_strings, item_size, strip_terminator, unsigned
from seriesmill.functions.times import device_time_ns, null_if_zero
from seriesmill.functions.values import ca_type_dim
from seriesmill.schemas import CA_FRAME

HEAD = 12


def read_frames(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(CA_FRAME).parquet(path)


def with_types(frames: DataFrame) -> DataFrame:
    """Split the request type id into metadata kind and scalar type, with the padding of time types."""
    return frames.join(F.broadcast(ca_type_dim(frames.sparkSession)), "data_type", "left")


def decode_events(frames: DataFrame, array_truncate: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Event rows of the captured frames, and the rejected frames with a reason.

    Waves keep no more elements than the payload holds and, if given, at most `array_truncate`;
    `truncated` marks those that hold fewer than their shape says.
    """
    typed = with_types(frames.filter("cmdid = 1"))
    size = F.when(F.col("ca_scalar_type") == "STRING", F.lit(40)).otherwise(item_size("ca_scalar_type"))
    scalar = F.col("data_count") == 1
    room = F.octet_length("payload") - HEAD - F.col("padding")
    text_scalar = scalar & (F.col("ca_scalar_type") == "STRING")
    reason = (
        F.when(F.col("meta").isNull(), "bad type id")
        .when(~F.col("is_time"), "not a time type")
        .when(F.octet_length("payload") < HEAD, "short metadata")
        .when(F.col("data_count") < 1, "bad count")
        .when(room < 0, "short payload")
        .when(scalar & ~text_scalar & (room < size), "short payload")
    )
    judged = typed.withColumn("reason", reason)
    good = judged.filter("reason is null")
    n = F.least(F.col("data_count"), F.floor(room / size).cast("int"), *([F.lit(array_truncate)] if array_truncate is not None else []))
    taken = F.when(text_scalar, room).when(scalar, size).otherwise(n * size)
    body = F.substring(F.col("payload"), F.col("padding") + HEAD + 1, taken.cast("int"))
    good = good.withColumn("_body", body).withColumn(
        "_v", decode_values("_body", F.col("ca_scalar_type"), F.lit(True))
    )
    kind = F.when(F.col("ca_scalar_type") == "ENUM", "I16").otherwise(F.col("ca_scalar_type"))
    text = F.col("ca_scalar_type") == "STRING"
    events = good.select(
        "seq",
        "recv_ts_ns",
        F.col("param2").alias("subid"),
        kind.alias("scalar_type"),
        F.when(scalar, F.array().cast("array<int>")).otherwise(F.array("data_count")).alias("shape_dims"),
        (~scalar & (n < F.col("data_count"))).alias("truncated"),
        null_if_zero(device_time_ns(unsigned("payload", 4, 4), unsigned("payload", 8, 4))).alias("ts_ns"),
        null_if_zero(unsigned("payload", 0, 2)).alias("status"),
        null_if_zero(unsigned("payload", 2, 2)).alias("severity"),
        "_v.ints",
        "_v.floats",
        F.when(text & scalar, strip_terminator("_body")).alias("text"),
        F.when(text & ~scalar, fixed_strings("_body")).alias("texts"),
    )
    return events, judged.filter("reason is not null").select(*frames.columns, "reason")
