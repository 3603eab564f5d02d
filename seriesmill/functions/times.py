"""Time arithmetic on LONG nanosecond columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesmill.schemas import EPICS_EPOCH_OFFSET, MINUTE, SECOND


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_to(ts: Column | str, step: int) -> Column:
    """Largest multiple of `step` not above `ts`."""
    ts = as_col(ts)
    return ts - F.pmod(ts, F.lit(step))


def offset_in_partition(ts: Column | str = "ts_ns", msp: Column | str = "ts_msp") -> Column:
    """Signed offset of a timestamp in its partition."""
    return as_col(ts) - as_col(msp)


def grid_cell(ts: Column | str, unit: int = 10 * SECOND, spacing: int = 30) -> Column:
    """Start of the grid cell in units: `ts / unit / spacing * spacing`."""
    units = bucket(ts, unit)
    return units - F.pmod(units, F.lit(spacing))


def bucket(ts: Column | str, step: int) -> Column:
    """Number of the `step` wide bucket that holds `ts`, in exact integer arithmetic."""
    return F.call_function("div", as_col(ts) - F.pmod(as_col(ts), F.lit(step)), F.lit(step))


def status_split(ts: Column | str, div: int = 60 * MINUTE) -> tuple[Column, Column]:
    """Partition part and offset of a status timestamp."""
    return floor_to(ts, div), F.pmod(as_col(ts), F.lit(div))


def device_time_ns(secs: Column | str, nanos: Column | str) -> Column:
    """Unix nanoseconds of device seconds since 1990 and nanoseconds."""
    secs, nanos = as_col(secs).cast("long"), as_col(nanos).cast("long")
    return (secs + F.lit(EPICS_EPOCH_OFFSET)) * F.lit(SECOND) + nanos


def global_time_ns(sec: Column | str, ns: Column | str) -> Column:
    return as_col(sec) * F.lit(SECOND) + as_col(ns)


def null_if_zero(c: Column | str) -> Column:
    """Zero stands for absent in device messages."""
    return F.nullif(as_col(c), F.lit(0))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def minute_floor(ts: Column | str = "ts_ns") -> Column:
    """Whole minute that holds `ts`, in seconds."""
    return bucket(ts, MINUTE) * 60


def iso_millis(ts: Column | str = "ts_ns") -> Column:
    """ISO-8601 UTC text with milliseconds; the session time zone must be UTC."""
    instant = F.timestamp_micros(bucket(ts, 1000))
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def second_and_nanos(ts: Column | str) -> tuple[Column, Column]:
    return bucket(ts, SECOND), F.pmod(as_col(ts), F.lit(SECOND))


def utc_date(ts: Column | str = "ts_ns") -> Column:
    """Calendar day of a timestamp, for partition columns."""
    return F.date_from_unix_date(bucket(ts, 24 * 60 * MINUTE).cast("int"))


def timestamp_of(ts: Column | str = "ts_ns") -> Column:
    """Spark TIMESTAMP of a nanosecond column, for watermarks and windows."""
    return F.timestamp_micros(bucket(ts, 1000))
