"""Streaming jobs: sources, sinks and the reports between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seriesmill.functions.times import timestamp_of
from seriesmill.functions.values import shape_kind
from seriesmill.operators.reports import most_active
from seriesmill.sinks.tables import with_part, write, write_events
from seriesmill.streaming.folds import lay_out_stream


def follow(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, pattern: str | None = None) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def ingest(events: DataFrame, root: str, checkpoint: str, available_now: bool = True, **kernels) -> StreamingQuery:
    """Gate, lay out and store a stream of events.

    Every micro-batch writes its own folders, so a repeated batch replaces its first attempt.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_events(batch.filter("admitted").withColumn("ts_lsp", F.col("ts_ns") - F.col("ts_msp")), root, batch_id)
            reports = batch.filter(~F.col("admitted")).withColumn("ema", F.col("report_ema")).withColumn("emd", F.col("report_emd"))
            write(with_part(reports), root, "receive_interval", batch_id)
        finally:
            batch.unpersist()

    writer = lay_out_stream(events, **kernels).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).foreachBatch(store).start()


def to_files(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def activity_stream(events: DataFrame, window: str = "60 seconds", delay: str = "10 seconds") -> DataFrame:
    """Events per window and series, given when the watermark passes the end of the window."""
    timed = events.withColumn("event_time", timestamp_of()).withWatermark("event_time", delay)
    latest = F.struct("ts_ns", "seq")
    return (
        timed.groupBy(F.window("event_time", window).alias("_w"), "series", shape_kind(most=2).alias("shape_kind"))
        .agg(F.count(F.lit(1)).alias("n"), F.max_by("pulse", latest).alias("last_pulse"))
        .select((F.unix_micros("_w.start") * 1000).alias("window"), "series", "shape_kind", "n", "last_pulse")
    )


def report_activity(events: DataFrame, path: str, checkpoint: str, n: int = 6, available_now: bool = True, **windows) -> StreamingQuery:
    """Write the busiest series of every finished window.

    All rows of a window arrive in the micro-batch that finishes it, so the ranking is complete.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        most_active(batch, n).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = activity_stream(events, **windows).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).foreachBatch(store).start()


def answer_stream(requests: DataFrame, answers: DataFrame, key: str, limit_ns: int, delay: str = "1 second") -> DataFrame:
    """First answer to every request of a stream within the limit, given once the watermark has passed it.

    The time bound lets Spark drop old rows of both sides; a request meets only answers of its
    own key and limit.
    """
    bound = F.expr(f"interval {limit_ns // 1000} microseconds")
    asked = requests.select(key, "ts_ns", "seq", timestamp_of().alias("asked_at")).withWatermark("asked_at", delay)
    answered = answers.select(
        F.col(key).alias("_key"),
        F.struct("ts_ns", "seq", "response_addr", "addr").alias("_answer"),
        timestamp_of().alias("answered_at"),
    ).withWatermark("answered_at", delay)
    near = (
        (F.col(key) == F.col("_key"))
        & (F.col("answered_at") >= F.col("asked_at"))
        & (F.col("answered_at") <= F.col("asked_at") + bound)
    )
    first = asked.join(answered, near, "leftOuter").groupBy(key, "ts_ns", "seq", "asked_at").agg(F.min("_answer").alias("_first"))
    hit = F.col("_first").isNotNull()
    return first.select(
        key,
        "ts_ns",
        "seq",
        "_first.response_addr",
        "_first.addr",
        F.coalesce(F.col("_first.ts_ns") - F.col("ts_ns"), F.lit(limit_ns)).alias("dt"),
        hit.alias("answered"),
    )
