"""Value, code and address expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.times import as_col
from seriesmill.schemas import (
    BOOL,
    CA_META,
    CA_PORT,
    CA_SCALAR_TYPES,
    CA_TIME_PADDING,
    CHANNEL_STATUS,
    CONNECTION_STATUS,
    INT,
    STRING,
    struct,
)
from seriesmill.session import small_table


def truncate_array(value: Column | str, n: int) -> Column:
    """The first `n` elements, or all of a shorter array."""
    return F.slice(as_col(value), 1, n)


def hash_bucket(series: Column | str = "series") -> Column:
    """Lowest byte of the series id."""
    return as_col(series).bitwiseAND(255)


def shape_kind(dims: Column | str = "shape_dims", most: int = 1) -> Column:
    """0 scalar, 1 with dimensions; with `most=2`, 2 for images."""
    return F.least(F.size(as_col(dims)), F.lit(most))


def interest_score(ema: Column | str = "ema") -> Column:
    """Reciprocal of the clamped receive interval; a channel without one is least interesting."""
    ivl = F.coalesce(as_col(ema), F.lit(1e10))
    return F.lit(1.0) / F.least(F.greatest(ivl, F.lit(1e-6)), F.lit(1e10))


def bool_bytes(payload: Column | str) -> Column:
    """One boolean per byte, true where the byte is not zero."""
    hexed = F.hex(as_col(payload))
    pairs = F.regexp_extract_all(hexed, F.lit("(..)"), F.lit(1))
    return F.transform(pairs, lambda p: p != F.lit("00"))


def pulse_split(pulse: Column | str) -> tuple[Column, Column]:
    """Upper part and lower 14 bits of a pulse number."""
    return F.shiftright(as_col(pulse), 14), as_col(pulse).bitwiseAND(0x3FFF)


def pulse_id(text: Column | str) -> Column:
    """Pulse number of a header field, 0 when it is not an integer."""
    plain = F.when(as_col(text).rlike(r"^-?\d+$"), as_col(text))
    return F.coalesce(plain.try_cast("long"), F.lit(0).cast("long"))


def normal_address(text: Column | str, default_port: int = CA_PORT) -> Column:
    """`host:port` of an address text; the default port is added, blanks become null."""
    t = F.trim(as_col(text))
    host = F.regexp_extract(t, r"^([^:/\s]+)(?::(\d{1,5}))?$", 1)
    port = F.regexp_extract(t, r"^([^:/\s]+)(?::(\d{1,5}))?$", 2)
    number = F.when(port == "", F.lit(default_port)).otherwise(port.try_cast("int"))
    return F.when((host != "") & number.between(0, 65535), F.concat_ws(":", host, number.cast("string")))


def socket_address(text: Column | str) -> Column:
    """The text itself if it is `IPv4:port`, else null."""
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    t = as_col(text)
    port = F.regexp_extract(t, r":(\d{1,5})$", 1).try_cast("int")
    return F.when(t.rlike(rf"^{octet}(\.{octet}){{3}}:\d{{1,5}}$") & (port <= 65535), t)


def typed_value(value: Column | str, actual: Column | str, wanted: str) -> Column:
    """The value where its declared type is the wanted one; null marks a mismatch."""
    return F.when(as_col(actual) == F.lit(wanted), as_col(value))


def connection_status_dim(spark: SparkSession) -> DataFrame:
    return small_table(spark, CONNECTION_STATUS, struct(kind=INT, status=STRING))


def channel_status_dim(spark: SparkSession) -> DataFrame:
    return small_table(spark, CHANNEL_STATUS, struct(kind=INT, status=STRING, reason=STRING))


def ca_type_dim(spark: SparkSession) -> DataFrame:
    """The 21 request types: metadata kind, scalar type and padding before the value."""
    rows = []
    for code in range(len(CA_META) * len(CA_SCALAR_TYPES)):
        meta, scalar = CA_META[code // 7], CA_SCALAR_TYPES[code % 7]
        rows.append((code, meta, scalar, CA_TIME_PADDING[scalar], meta == "time"))
    return small_table(
        spark, rows, struct(data_type=INT, meta=STRING, ca_scalar_type=STRING, padding=INT, is_time=BOOL)
    )


def with_status_names(df: DataFrame, dim: DataFrame, kind: str = "kind") -> tuple[DataFrame, DataFrame]:
    """Name the status codes of `df`; rows with an unknown code go to the second result."""
    named = df.join(F.broadcast(dim.withColumnRenamed("kind", kind)), kind, "left")
    return named.filter("status is not null"), named.filter("status is null").select(*df.columns)
