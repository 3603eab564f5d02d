"""Tables as versioned lists of files, with a zone map that says which files a read has to open.

An append writes the rows of a batch into a folder of its own, clustered by series and time within
the table's partitions, and then commits a new version: a list of all live files, each with the
smallest and largest series and time and the write times it holds. Versions are numbered by a
file that only one writer can create; who comes second reads the new list and tries again. A reader takes
the files of one version, so it never sees half a commit: compaction and expiry make new versions, and
files that no version of the last while lists are deleted later (`vacuum`).

Every row has `batch` and `written_at`, the time of its append in nanoseconds, so that expiry goes by
the age of a row even after its file was joined with others.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.times import utc_date
from seriesmill.operators.layout import RETENTION, grid_index, partition_index
from seriesmill.schemas import HOUR, LONG, STRING
from seriesmill.session import small_table
from seriesmill.sinks.tables import TABLES, Table, event_rows, shaped, partition_columns_as_they_are

# The time by which the files of a table are told apart, where it isn't ts_ns.
ZONE_TIME = {
    "ts_msp": "ts_msp", "series_by_ts_msp": "ts_msp_grid", "connection_status": "ts_msp", "channel_status": "ts_msp", "channel_status_by_time": "ts_msp",
    "channel_ping": "minute", "binned_scalar_f32": "off_msp",
}
LISTED = T.StructType(
    [T.StructField(n, t) for n, t in (("path", STRING), ("partition", STRING))]
    + [T.StructField(n, LONG) for n in ("size", "n_rows", "series_lo", "series_hi", "time_lo", "time_hi", "written_lo", "written_hi")]
    + [T.StructField("batches", T.ArrayType(LONG))]
)
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Other writers kept committing first."""


class ArchiveFiles:
    """The tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Files and versions

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def versions(self, table: str) -> list[int]:
        fs, where = self._fs(f"{self.root}/_files/{table}")
        if not fs.exists(where):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit())

    def _list_of(self, table: str, version: int) -> str:
        fs, where = self._fs(f"{self.root}/_files/{table}/{version:012d}")
        stream = fs.open(where)
        try:
            return f"{self.root}/_files/{table}/" + self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def files(self, table: str, version: int | None = None) -> DataFrame:
        """The live files of a version, the last one by default."""
        known = self.versions(table)
        if not known:
            return small_table(self.spark, [], LISTED)
        return self.spark.read.schema(LISTED).parquet(self._list_of(table, known[-1] if version is None else version))

    def _commit(self, table: str, change) -> int | None:
        """Write the list that `change` makes of the last one as the next version; null lists change nothing."""
        for _ in range(ATTEMPTS):
            known = self.versions(table)
            new = change(self.files(table, known[-1] if known else None))
            if new is None:
                return None
            name = f"list-{uuid.uuid4().hex}"
            new.hint("rebalance").write.parquet(f"{self.root}/_files/{table}/{name}")
            version = (known[-1] if known else 0) + 1
            fs, where = self._fs(f"{self.root}/_files/{table}/{version:012d}")
            try:
                out = fs.create(where, False)
            except Py4JJavaError as taken:
                if "FileAlreadyExists" not in str(taken):
                    raise
                continue
            out.writeBytes(name)
            out.close()
            return version
        raise Conflict(table)

    # Writing

    def _schema(self, spec: Table) -> T.StructType:
        return T.StructType([*spec.columns.fields, T.StructField("batch", LONG), T.StructField("written_at", LONG)])

    def _order(self, spec: Table) -> list[str]:
        return [*spec.partition, *dict.fromkeys(c for c in ("series", *spec.key) if c in spec.columns.names and c not in spec.partition)]

    def _write(self, rows: DataFrame, spec: Table, rows_per_file: int | None) -> DataFrame:
        """Write rows into a new folder, ranges of series together; its list of files."""
        folder, order = f"{self.root}/{spec.name}/commit={uuid.uuid4().hex}", self._order(spec)
        writer = partition_columns_as_they_are(rows, spec.partition).repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd")
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        if spec.partition:
            writer = writer.partitionBy(*spec.partition)
        writer.parquet(folder)
        written = self.spark.read.schema(self._schema(spec)).parquet(folder)
        has_series = "series" in spec.columns.names
        zone = lambda f, c: f(c).cast("long") if c else F.lit(None).cast("long")
        series, time = "series" if has_series else None, ZONE_TIME.get(spec.name, "ts_ns")
        parts = F.to_json(F.struct(*spec.partition)) if spec.partition else F.lit("")
        return written.groupBy(F.col("_metadata.file_path").alias("path"), parts.alias("partition"), F.col("_metadata.file_size").alias("size")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            zone(F.min, series).alias("series_lo"),
            zone(F.max, series).alias("series_hi"),
            zone(F.min, time).alias("time_lo"),
            zone(F.max, time).alias("time_hi"),
            F.min("written_at").alias("written_lo"),
            F.max("written_at").alias("written_hi"),
            F.sort_array(F.collect_set("batch")).alias("batches"),
        )

    def append(self, rows: DataFrame, table: str, batch_id: int, now_ns: int, rows_per_file: int | None = None) -> int | None:
        """Add a batch of rows; the new version. A batch that is in the table already is left as it is."""
        spec = TABLES[table]
        if not self.files(table).filter(F.array_contains("batches", F.lit(batch_id).cast("long"))).isEmpty():
            return None
        stamped = shaped(rows, spec).withColumns({"batch": F.lit(batch_id).cast("long"), "written_at": F.lit(now_ns).cast("long")})
        added = self._write(stamped, spec, rows_per_file).select(*LISTED.names)

        def change(live: DataFrame) -> DataFrame | None:
            # another writer may have brought the same batch meanwhile
            if not live.filter(F.array_contains("batches", F.lit(batch_id).cast("long"))).isEmpty():
                return None
            return live.unionByName(added)

        return self._commit(table, change)

    # Reading

    def _rows(self, spec: Table, paths: Sequence[str]) -> DataFrame:
        schema = self._schema(spec)
        if not paths:
            return small_table(self.spark, [], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{spec.name}").parquet(*paths).select(*schema.names)

    def read(
        self, table: str, series: Sequence[int] | None = None, from_time: int | None = None, to_time: int | None = None,
        version: int | None = None, written_after: int | None = None,
    ) -> DataFrame:
        """Rows of the chosen series in a time range (by the table's own time), from the files that can hold any."""
        spec = TABLES[table]
        base, time = TABLES[spec.folder or spec.name], ZONE_TIME.get(spec.folder or spec.name, "ts_ns")
        listed = self.files(base.name, version)
        keep = F.lit(True)
        if series is not None:
            wanted = F.array(*[F.lit(int(s)).cast("long") for s in series]) if series else F.array().cast("array<long>")
            listed = listed.filter(F.exists(wanted, lambda s: s.between(F.col("series_lo"), F.col("series_hi"))))
            keep = keep & F.col("series").isin([int(s) for s in series])
        if from_time is not None:
            listed, keep = listed.filter(F.col("time_hi") >= from_time), keep & (F.col(time) >= from_time)
        if to_time is not None:
            listed, keep = listed.filter(F.col("time_lo") <= to_time), keep & (F.col(time) <= to_time)
        if written_after is not None:
            listed, keep = listed.filter(F.col("written_hi") > written_after), keep & (F.col("written_at") > written_after)
        paths = [r["path"] for r in listed.select("path").collect()]
        rows = self._rows(base, paths).filter(keep)
        return rows.filter(spec.where).select(*spec.columns.names, "batch", "written_at") if spec.where else rows

    # Upkeep

    def expire(self, table: str, now_ns: int, retention: Mapping[str, int] = RETENTION) -> int | None:
        """Take files out whose rows are all older than the table's retention; the new version.

        Rows of a file that also holds younger ones stay on disk; a read with `written_after` leaves them out.
        """
        bound = now_ns - retention[TABLES[table].retention]

        def change(live: DataFrame) -> DataFrame | None:
            return None if live.filter(F.col("written_hi") <= bound).isEmpty() else live.filter(F.col("written_hi") > bound)

        return self._commit(table, change)

    def compact(self, table: str, now_ns: int, settle_ns: int = HOUR, small: int = 64 << 20, least: int = 4, retention: Mapping[str, int] = RETENTION, rows_per_file: int | None = None) -> int | None:
        """Join the small files of every partition that has at least `least` of them, none younger than `settle_ns`; the new version.

        Files whose rows are all expired are left to `expire`; expired rows of others are not copied.
        """
        spec = TABLES[table]
        bound = now_ns - retention[spec.retention]
        mine = self.files(table).filter((F.col("size") < small) & (F.col("written_hi") <= now_ns - settle_ns) & (F.col("written_hi") > bound))
        groups = mine.groupBy("partition").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("partition")
        old = [r["path"] for r in mine.join(groups, "partition", "left_semi").select("path").collect()]
        if not old:
            return None
        added = self._write(self._rows(spec, old).filter(F.col("written_at") > bound), spec, rows_per_file).select(*LISTED.names)
        gone = small_table(self.spark, [(p,) for p in old], T.StructType([T.StructField("path", STRING)]))

        def change(live: DataFrame) -> DataFrame | None:
            # another writer may have replaced or expired some of them: then this work is void
            if live.join(gone, "path", "left_semi").count() < len(old):
                return None
            return live.join(F.broadcast(gone), "path", "left_anti").unionByName(added)

        return self._commit(table, change)

    def vacuum(self, table: str, keep_versions: int = 10) -> int:
        """Delete the lists before the last `keep_versions`, and the files that only those listed; gives their number.

        Folders of appends that are under way are not touched: only files that a dropped version listed are deleted.
        """
        known = self.versions(table)
        dropped, kept = known[:-keep_versions], known[-keep_versions:]
        if not dropped:
            return 0
        listed = lambda some: self.spark.read.schema(LISTED).parquet(*[self._list_of(table, v) for v in some]).select("path").distinct()
        gone = [r["path"] for r in listed(dropped).join(listed(kept), "path", "left_anti").collect()]
        lists = [self._list_of(table, v) for v in dropped]
        for path in [*gone, *lists, *[f"{self.root}/_files/{table}/{v:012d}" for v in dropped]]:
            fs, where = self._fs(path)
            fs.delete(where, True)
        return len(gone)


def write_events(archive: ArchiveFiles, laid_out: DataFrame, batch_id: int, now_ns: int, rows_per_file: int | None = None) -> None:
    """A batch of events with layout columns, and the indexes made from what was written."""

    archive.append(event_rows(laid_out), "events", batch_id, now_ns, rows_per_file)
    files = archive.files("events").filter(F.array_contains("batches", F.lit(batch_id).cast("long")))
    stored = archive._rows(TABLES["events"], [r["path"] for r in files.select("path").collect()]).filter(F.col("batch") == batch_id)
    if "ts_msp" in laid_out.columns:
        archive.append(partition_index(stored).withColumn("date", utc_date("ts_msp")), "ts_msp", batch_id, now_ns, rows_per_file)
    if "ts_msp_grid" in laid_out.columns:
        archive.append(grid_index(stored), "series_by_ts_msp", batch_id, now_ns, rows_per_file)
