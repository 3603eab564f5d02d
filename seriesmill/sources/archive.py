"""Reading events back through the registry and the indexes."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators.joins import join_sized
from seriesmill.operators.layout import last_write_wins
from seriesmill.operators.registry import series_of_channel
from seriesmill.schemas import DAY, HOUR
from seriesmill.sinks.archive_files import ArchiveFiles
from seriesmill.sinks.tables import TABLES, read


def day_text(ns: int) -> str:
    return (datetime.date(1970, 1, 1) + datetime.timedelta(days=ns // DAY)).isoformat()


def in_range(events: DataFrame, from_ns: int, to_ns: int) -> DataFrame:
    """Events of a time range; the day bounds prune partitions."""
    days = F.col("date").between(day_text(from_ns), day_text(to_ns))
    return events.filter(days & F.col("ts_ns").between(from_ns, to_ns))


def candidate_partitions(index: DataFrame, series: DataFrame, from_ns: int, to_ns: int, span_ns: int) -> DataFrame:
    """Partitions of the series that can hold events of the range; a partition is at most `span_ns` long."""
    near = index.filter(F.col("ts_msp").between(from_ns - span_ns, to_ns))
    return near.join(series.select("series").distinct(), "series", "left_semi").select("series", "ts_msp").distinct()


def status_range(spark: SparkSession, root: str, from_ns: int, to_ns: int, div_ns: int = HOUR) -> DataFrame:
    """Channel statuses of all series in a time range, from the layout by time: days, then row groups by their times."""
    rows = read(spark, root, "channel_status_by_time")
    near = rows.filter(F.col("date").between(day_text(from_ns), day_text(to_ns)) & F.col("ts_msp").between(from_ns // div_ns * div_ns, to_ns))
    return near.withColumn("ts_ns", F.col("ts_msp") + F.col("ts_lsp")).filter(F.col("ts_ns").between(from_ns, to_ns))


def read_range(
    spark: SparkSession,
    root: str,
    registry: DataFrame,
    backend: str,
    channel: str,
    from_ns: int,
    to_ns: int,
    table: str = "events_scalar",
    span_ns: int = DAY,
) -> DataFrame:
    """Events of one channel in a time range: series, then partitions, then events.

    Repeated writes of an event are resolved here; the last one wins.
    """
    series = series_of_channel(registry, backend, channel)
    partitions = candidate_partitions(read(spark, root, "ts_msp"), series, from_ns, to_ns, span_ns)
    events = in_range(read(spark, root, table), from_ns, to_ns)
    found = join_sized(events, partitions, ["series", "ts_msp"], "left_semi")
    return last_write_wins(found, TABLES[table].key, ("batch", "seq"))


def read_channel(
    archived: ArchiveFiles, registry: DataFrame, backend: str, channel: str, from_ns: int, to_ns: int, table: str = "events_scalar", written_after: int | None = None
) -> DataFrame:
    """Events of one channel in a time range, from the files whose zones can hold any.

    A channel has one series per type and shape it ever had, so few are collected. The last write of an event wins.
    """
    series = [r["series"] for r in series_of_channel(registry, backend, channel).select("series").distinct().collect()]
    found = archived.read(table, series, from_ns, to_ns, written_after=written_after)
    return last_write_wins(found, TABLES[table].key, ("batch", "seq"))


def active_series(grid_index: DataFrame, first_cell: int, last_cell: int) -> DataFrame:
    """Series with events in a range of grid cells."""
    return grid_index.filter(F.col("ts_msp_grid").between(first_cell, last_cell)).select("series").distinct()


def list_pulses(pulses: DataFrame) -> DataFrame:
    return pulses.select("tsa", "tsb", "pulse")
