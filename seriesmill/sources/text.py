"""Channel lists in text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators.quality import include_channels


def channel_lines(lines: DataFrame, whitelist: str | None = None, blacklist: str | None = None, column: str = "value") -> DataFrame:
    """Trimmed, non-blank lines that pass the include rule."""
    names = lines.select(F.trim(F.col(column)).alias("channel")).filter(F.col("channel") != "")
    return include_channels(names, whitelist, blacklist)


def read_channels(spark: SparkSession, path: str, whitelist: str | None = None, blacklist: str | None = None) -> DataFrame:
    return channel_lines(spark.read.text(path), whitelist, blacklist)
