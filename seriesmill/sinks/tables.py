"""The archive's tables: layout, writing, routing and expiry.

A batch writes each table into a folder of its own number, which a repeated batch overwrites:
delivery is exactly once per table. Within it, tables are partitioned by type and day and sorted
by series and time in every file. A rebalance before the write splits large partitions and joins
small ones, so one busy day or series does not become one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.times import status_split, utc_date
from seriesmill.operators.layout import grid_index, partition_index
from seriesmill.schemas import BOOL, DOUBLE, HOUR, INT, INTS, LONG, STRING, struct


@dataclass(frozen=True)
class Table:
    """Columns, partition columns, primary key and retention class of one table.

    Scalar and array events share a folder: one pass over a batch writes both, and a partition
    column tells them apart. Files of a `ranged` table hold ranges of its key that do not overlap.
    """

    name: str
    columns: T.StructType
    partition: tuple[str, ...]
    key: tuple[str, ...]
    retention: str
    folder: str | None = None
    where: str | None = None
    ranged: bool = False


FLOATS = T.ArrayType(T.FloatType())
_EVENT = dict(
    series=LONG, ts_msp=LONG, ts_lsp=LONG, ts_ns=LONG, seq=LONG, pulse=LONG, shape_dims=INTS, msp_bump=BOOL, ts_msp_grid=LONG
)
_SCALAR = dict(ivalue=LONG, fvalue=DOUBLE, svalue=STRING, bvalue=BOOL)
_ARRAY = dict(ivalues=T.ArrayType(LONG), fvalues=T.ArrayType(DOUBLE), svalues=T.ArrayType(STRING), bvalues=T.ArrayType(BOOL))
_PLACE = dict(rank=INT, scalar_type=STRING, date=T.DateType())
_EVENT_KEY = ("series", "ts_msp", "ts_lsp")

TABLES = {
    t.name: t
    for t in (
        Table("events", struct(**_EVENT, **_SCALAR, **_ARRAY, **_PLACE), tuple(_PLACE), _EVENT_KEY, "scalar"),
        Table("events_scalar", struct(**_EVENT, **_SCALAR, **_PLACE), tuple(_PLACE), _EVENT_KEY, "scalar", "events", "rank = 0"),
        Table("events_array", struct(**_EVENT, **_ARRAY, **_PLACE), tuple(_PLACE), _EVENT_KEY, "array", "events", "rank = 1"),
        Table("ts_msp", struct(series=LONG, ts_msp=LONG, date=T.DateType()), ("date",), ("series", "ts_msp"), "index"),
        Table("series_by_ts_msp", struct(part=INT, ts_msp_grid=LONG, shape_kind=INT, scalar_type=STRING, series=LONG),
              (), ("part", "ts_msp_grid", "shape_kind", "scalar_type", "series"), "index"),
        Table("connection_status", struct(ts_msp=LONG, ts_lsp=LONG, kind=INT, addr=STRING, date=T.DateType()),
              ("date",), ("addr", "ts_msp", "ts_lsp"), "index"),
        Table("channel_status", struct(series=LONG, ts_msp=LONG, ts_lsp=LONG, kind=INT, date=T.DateType()),
              ("date",), ("series", "ts_msp", "ts_lsp"), "index"),
        Table("channel_status_by_time", struct(ts_msp=LONG, ts_lsp=LONG, series=LONG, kind=INT, date=T.DateType()),
              ("date",), ("ts_msp", "ts_lsp", "series"), "index", ranged=True),
        Table("channel_ping", struct(part=INT, minute=LONG, series=LONG, ivl=DOUBLE, interest=DOUBLE, evsize=INT, date=T.DateType()),
              ("date",), ("part", "minute", "series"), "index"),
        Table("muted", struct(part=INT, series=LONG, ts_ns=LONG, ema=DOUBLE, emd=DOUBLE, date=T.DateType()),
              ("date",), ("part", "series", "ts_ns"), "index"),
        Table("receive_interval", struct(part=INT, series=LONG, ts_ns=LONG, ema=DOUBLE, emd=DOUBLE, date=T.DateType()),
              ("date",), ("part", "series", "ts_ns"), "index"),
        Table("binned_scalar_f32", struct(series=LONG, bin_len_sec=LONG, bin_count=INT, off_msp=LONG, off_lsp=LONG,
                                          counts=T.ArrayType(LONG), mins=FLOATS, maxs=FLOATS, avgs=FLOATS),
              (), ("series", "bin_len_sec", "bin_count", "off_msp", "off_lsp"), "binned"),
    )
}

# Scalar types by the typed column that holds them; u64 is widened to text.
TYPED = {
    "ivalue": ("I8", "I16", "I32", "I64", "U8", "U16", "U32", "ENUM"),
    "fvalue": ("F32", "F64"),
    "svalue": ("STRING", "U64"),
    "bvalue": ("BOOL",),
}


def shaped(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns in order; missing ones become null."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.columns]
    )


def partition_columns_as_they_are(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The same values in columns that are neither constant for the optimizer nor text that can be null.

    For both the writer of partitioned files puts in a sort of its own by the partition columns, and
    the sort by series and time before it is dropped. Empty text is stored as null, as null would be.
    """
    here = F.spark_partition_id() >= 0
    text = lambda c: isinstance(df.schema[c].dataType, T.StringType)
    return df.withColumns({c: F.coalesce(F.when(here, F.col(c)), F.lit("")) if text(c) else F.when(here, F.col(c)) for c in columns})


def write(df: DataFrame, root: str, table: str, batch_id: int, sort: tuple[str, ...] | None = None) -> None:
    """Write one batch of one table, in place of an earlier attempt at the same batch."""
    spec = TABLES[table]
    out = partition_columns_as_they_are(shaped(df, spec), spec.partition)
    order = sort or tuple(c for c in spec.key if c not in spec.partition)
    spread = out.repartitionByRange(*spec.partition, *order) if spec.ranged else out.hint("rebalance", *spec.partition)
    writer = spread.sortWithinPartitions(*spec.partition, *order).write.mode("overwrite")
    if spec.partition:
        writer = writer.partitionBy(*spec.partition)
    writer.parquet(f"{root}/{table}/batch={batch_id}")


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    spec = TABLES[table]
    schema = T.StructType([*spec.columns.fields, T.StructField("batch", LONG)])
    rows = spark.read.schema(schema).parquet(f"{root}/{spec.folder or table}")
    return rows.filter(spec.where) if spec.where else rows


def event_rows(events: DataFrame) -> DataFrame:
    """Events with their place in the table, a plain `value` in the column of its type."""
    cols = {"rank": F.least(F.size("shape_dims"), F.lit(1)), "date": utc_date()}
    if "value" in events.columns:
        for column, kinds in TYPED.items():
            to = {f.name: f.dataType for f in TABLES["events"].columns}[column]
            cols[column] = F.when(F.col("scalar_type").isin(*kinds), F.col("value").cast(to))
    return events.withColumns(cols)


def write_events(laid_out: DataFrame, root: str, batch_id: int) -> None:
    """Events with their layout columns to the event table, and the indexes from what was written.

    The layout is computed once; the indexes read three columns of the stored batch.
    """
    write(event_rows(laid_out), root, "events", batch_id)
    stored = read(laid_out.sparkSession, root, "events").filter(F.col("batch") == batch_id)
    if "ts_msp" in laid_out.columns:
        write(partition_index(stored).withColumn("date", utc_date("ts_msp")), root, "ts_msp", batch_id)
    if "ts_msp_grid" in laid_out.columns:
        write(grid_index(stored), root, "series_by_ts_msp", batch_id)


def status_rows(items: DataFrame, div_ns: int = HOUR) -> DataFrame:
    """Status items with their time split into partition and offset."""
    msp, lsp = status_split("ts_ns", div_ns)
    return items.withColumn("ts_msp", msp).withColumn("ts_lsp", lsp).withColumn("date", utc_date())


def with_part(items: DataFrame, ts: str = "ts_ns") -> DataFrame:
    return items.withColumn("part", F.col("series").bitwiseAND(255)).withColumn("date", utc_date(ts))


def ping_rows(pings: DataFrame) -> DataFrame:
    rows = pings.withColumn("_ts", F.col("minute") * 1_000_000_000)
    return with_part(rows, "_ts").drop("_ts")


# Item kind, its table and the rows it becomes.
ROUTES = {
    "connection_status": ("connection_status", status_rows),
    "channel_status": ("channel_status", status_rows),
    "channel_ping": ("channel_ping", ping_rows),
    "mute": ("muted", with_part),
    "interval": ("receive_interval", with_part),
    "bin_patch": ("binned_scalar_f32", lambda df: df),
}


def route_items(items: DataFrame, root: str, batch_id: int) -> None:
    """Write a mixed batch of items: events and six other kinds, told apart by `item`.

    The batch is cached because every destination reads it once; losing a cached block only
    recomputes it.
    """
    items.persist()
    try:
        write_events(items.filter("item = 'insert'"), root, batch_id)
        for kind, (table, rows) in ROUTES.items():
            of_kind = rows(items.filter(F.col("item") == kind))
            if kind == "channel_status":
                write_channel_status(of_kind, root, batch_id)
            else:
                write(of_kind, root, table, batch_id)
    finally:
        items.unpersist()


def write_channel_status(rows: DataFrame, root: str, batch_id: int) -> None:
    """A batch of the channel status log in both layouts: by series, and by time for reads over all series."""
    write(rows, root, "channel_status", batch_id)
    write(rows, root, "channel_status_by_time", batch_id)


def ensure_table(spark: SparkSession, table: str, database: str = "default") -> bool:
    """Create the managed table if missing, else add the columns it lacks; true if it was created."""
    spec = TABLES[table]
    name = f"{database}.{table}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.columns)
        by = f" PARTITIONED BY ({', '.join(spec.partition)})" if spec.partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")
        return True
    have = {c.name for c in spark.catalog.listColumns(name)}
    lacking = [f"`{f.name}` {f.dataType.simpleString()}" for f in spec.columns if f.name not in have]
    if lacking:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(lacking)})")
    return False


def check_readable(spark: SparkSession, table: str, database: str = "default") -> bool:
    """Whether the table is there and can be scanned; a failure to read its files is raised."""
    try:
        spark.table(f"{database}.{table}").limit(1).collect()
    except AnalysisException:
        return False
    return True


def key_violations(df: DataFrame, table: str) -> DataFrame:
    """Primary keys that occur more than once."""
    return df.groupBy(*TABLES[table].key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def drop_expired(spark: SparkSession, table: str, before: str, database: str = "default") -> int:
    """Drop the day partitions before a date of a managed table; gives their number."""
    name, dropped = f"{database}.{table}", 0
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        parts = dict(p.split("=", 1) for p in row[0].split("/"))
        if parts["date"] < before:
            spec = ", ".join(f"{k} = '{v}'" for k, v in parts.items())
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
            dropped += 1
    return dropped
