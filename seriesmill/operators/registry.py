"""Series registry: a stable numeric id for every channel key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.joins import join_sized
from seriesmill.schemas import CHANNEL_KEY, STATUS_SCALAR_TYPE
from seriesmill.session import cut_lineage

KEY = list(CHANNEL_KEY)

# Range of valid series ids and number of salts tried.
LEAST_ID = 100_000_000_000_000_000
GREATEST_ID = 2**63 - 1
MAX_SALTS = 64


def dims_text(dims: Column | str = "shape_dims") -> Column:
    return F.concat(F.lit("["), F.array_join(dims, ", "), F.lit("]"))


def candidate_id(salt: Column) -> Column:
    """First 8 bytes of the key's md5, read as a little-endian number."""
    text = F.concat_ws(
        "|", "backend", "channel", F.col("scalar_type").cast("string"), dims_text(), salt.cast("string")
    )
    digest = F.md5(text)
    swapped = F.concat(*[F.substring(digest, 2 * i + 1, 2) for i in reversed(range(8))])
    return F.conv(swapped, 16, 10).cast("decimal(20,0)")


def first_valid(from_salt: Column) -> Column:
    """The first salt at or after `from_salt` whose candidate is a valid id, with that id."""

    def step(found: Column, salt: Column) -> Column:
        candidate = candidate_id(salt)
        valid = (salt >= from_salt) & candidate.between(F.lit(LEAST_ID), F.lit(GREATEST_ID))
        fresh = F.when(valid, F.struct(salt.alias("salt"), candidate.cast("long").alias("series")))
        return F.when(found.isNotNull(), found).otherwise(fresh)

    none = F.lit(None).cast("struct<salt:int,series:bigint>")
    return F.aggregate(F.sequence(F.lit(0), F.lit(MAX_SALTS - 1)), none, step)


def lookup(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Every request with its series id, null where the key is not registered."""
    known = registry.filter("agg_kind = 0").select("series", *KEY)
    return join_sized(requests, known, KEY, "left")


def missing(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct keys of the requests that are not registered."""
    known = registry.filter("agg_kind = 0").select(*KEY)
    return requests.select(*KEY).distinct().join(known, KEY, "left_anti")


def assign_ids(keys: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows for new keys.

    An id already taken, by a registered series or by a smaller new key, sends its key to the
    next salt. Collisions are rare; the usual cost is one check.
    """
    pick = first_valid(F.col("from_salt"))
    assigned = keys.withColumn("from_salt", F.lit(0)).withColumn("_pick", pick)
    taken = registry.select("series").distinct().withColumn("_taken", F.lit(True))
    assigned = cut_lineage(assigned.select(*KEY, "_pick.salt", "_pick.series"))
    for _ in range(MAX_SALTS):
        rival = F.row_number().over(Window.partitionBy("series").orderBy(*KEY))
        judged = assigned.withColumn("_rank", rival).join(taken, "series", "left")
        loses = F.col("_taken").isNotNull() | (F.col("_rank") > 1) | F.col("series").isNull()
        losers = judged.filter(loses)
        if losers.isEmpty():
            return assigned.select("series", *KEY, F.lit(0).alias("agg_kind"))
        again = losers.select(*KEY, (F.col("salt") + 1).alias("from_salt")).withColumn("_pick", pick)
        kept = judged.filter(~loses).select(*KEY, "salt", "series")
        assigned = cut_lineage(kept.unionByName(again.select(*KEY, "_pick.salt", "_pick.series")))
    raise RuntimeError("no free series id after trying every salt")


def get_or_create(requests: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Answer every request with `series` and `is_new`; also gives the rows to append to the registry."""
    created = assign_ids(missing(requests, registry), registry)
    known = registry.filter("agg_kind = 0").select("series", *KEY, F.lit(False).alias("is_new"))
    every = known.unionByName(created.select("series", *KEY, F.lit(True).alias("is_new")))
    return join_sized(requests, every, KEY, "left"), created


def append_absent(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """The registry with those rows whose key it lacks; one row per new key."""
    fresh = rows.dropDuplicates([*KEY, "agg_kind"]).join(registry.select(*KEY, "agg_kind"), [*KEY, "agg_kind"], "left_anti")
    return registry.unionByName(fresh)


def status_requests(channels: DataFrame) -> DataFrame:
    """Requests for the status series of every channel."""
    return channels.select("backend", "channel").distinct().select(
        "backend",
        "channel",
        F.lit(STATUS_SCALAR_TYPE).alias("scalar_type"),
        F.array().cast("array<int>").alias("shape_dims"),
    )


def series_of_channel(registry: DataFrame, backend: str, channel: str) -> DataFrame:
    """All type and shape variants of one channel."""
    return registry.filter((F.col("backend") == backend) & (F.col("channel") == channel)).select(
        "series", "scalar_type", "shape_dims"
    )
