"""Joins of a large table to one that may be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow table (keys and a few columns) that are safe to hold on every executor.
BROADCAST_ROWS = 1_000_000


def join_sized(large: DataFrame, other: DataFrame, keys: Sequence[str], how: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join without moving `large` if the other side is counted to be small.

    Beyond `max_rows` both sides are shuffled, and AQE splits the partitions of hot keys. The
    count reads no more columns than its plan needs, and spares a shuffle of the large side.
    """
    if other.isStreaming or other.count() > max_rows:
        return large.join(other, list(keys), how)
    return large.join(F.broadcast(other), list(keys), how)
