"""Streams whose series may be of any size.

Every micro-batch goes through the table operators, which cut large series into slices and fold them
in parallel, so a series that makes up most of a stream does not become one task. What a micro-batch
hands on to the next, one row per series, is a table by batch number: batch n reads the folder of
batch n - 1 and writes its own in place of an earlier attempt, so a repeated batch starts where its
first attempt did. Output folders are by batch too. A root belongs to one query and its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seriesmill.functions.times import bucket, offset_in_partition
from seriesmill.operators.bins import touch_bins
from seriesmill.operators.fold import ENTRY, EXIT, Chain, exit_states, fold
from seriesmill.operators.kernels import GridChange, IntervalGate, PartitionRoll
from seriesmill.operators.slicing import DEFAULT_POLICY, Ordered, SlicePolicy
from seriesmill.schemas import DOUBLE, LONG, MINUTE, SECOND, struct
from seriesmill.session import cut_lineage, small_table
from seriesmill.sinks.tables import with_part, write, write_events

MILLI = 1_000_000
MARK = struct(mark=LONG)


class Handover:
    """The tables one micro-batch leaves to the next."""

    def __init__(self, spark: SparkSession, root: str, batch_id: int):
        self.spark, self.root, self.batch = spark, root, batch_id

    def _path(self, name: str, batch_id: int) -> str:
        return f"{self.root}/_state/{name}/batch={batch_id}"

    def taken(self, name: str, schema: T.StructType) -> DataFrame:
        """What the batch before left; empty for the first one."""
        if self.batch == 0:
            return small_table(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(self._path(name, self.batch - 1))

    def leave(self, name: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(self._path(name, self.batch))
        return self.spark.read.schema(rows.schema).parquet(self._path(name, self.batch))

    def mark(self) -> int | None:
        row = self.taken("mark", MARK).first()
        return row["mark"] if row else None

    def leave_mark(self, mark: int | None) -> None:
        self.leave("mark", small_table(self.spark, [(mark,)], MARK))

    def forget(self, *names: str) -> None:
        """Delete what the batch before the last left: nothing reads it again once this batch has started."""
        if self.batch < 2:
            return
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name, self.batch - 2))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def each_batch(rows: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], available_now: bool = True) -> StreamingQuery:
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).foreachBatch(step).start()


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in as many parts as there are cores, written down: a micro-batch can be one file, and with it one task."""
    return cut_lineage(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism))


def _settled_to(batch: DataFrame, before: int | None, delay_ns: int) -> int | None:
    """The time up to which rows are settled, in whole milliseconds: the newest row's less the delay; it never goes back."""
    newest = batch.agg(F.max("ts_ns")).first()[0]
    here = None if newest is None else newest // MILLI * MILLI - delay_ns
    return max((m for m in (before, here) if m is not None), default=None)


def _replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The old rows of the keys that the new ones lack, and the new ones; null is a key like others."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    latest = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_new").alias("_row"))
    return latest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def bin_batches(
    events: DataFrame,
    root: str,
    checkpoint: str,
    bin_ns: int = MINUTE,
    delay_ns: int = 10 * SECOND,
    key: str = "series",
    *,
    max_carry_ns: int,
    policy: SlicePolicy = DEFAULT_POLICY,
    available_now: bool = True,
) -> StreamingQuery:
    """Time-weighted bins of a stream, written to `root/bins` as runs once the settled time has passed them.

    Rows are settled `delay_ns` behind the newest one. State per series: the rows not settled yet, the last
    settled value and how far it has been counted, and the one bin that is open. A value is carried on for
    at most `max_carry_ns`, which has to be positive, also when its series has gone silent. Rows that come
    after their time was settled go to `root/late`; rows without a time are left out.
    `operators.bins.expand_runs` takes the runs apart.
    """
    if max_carry_ns <= 0:
        raise ValueError("max_carry_ns has to be positive")
    kind = events.schema[key].dataType
    row = T.StructType([T.StructField(key, kind), *struct(ts_ns=LONG, seq=LONG, value=DOUBLE).fields])
    carried = T.StructType([*row.fields, T.StructField("at", LONG)])
    opened = T.StructType([T.StructField(key, kind), *_SUMS.fields])

    def step(batch: DataFrame, batch_id: int) -> None:
        state = Handover(batch.sparkSession, root, batch_id)
        before = state.mark()
        new = batch.select(key, "ts_ns", "seq", F.col("value").cast("double").alias("value")).filter("ts_ns is not null")
        mark = _settled_to(new, before, delay_ns)
        if before is not None:
            new.filter(F.col("ts_ns") < before).write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
            new = new.filter(F.col("ts_ns") >= before)
        waiting = state.taken("pending", row).unionByName(new)
        limit = F.lit(mark).cast("long")
        state.leave("pending", waiting.filter(F.coalesce(F.col("ts_ns") >= limit, F.lit(True))))
        ready = waiting.filter(F.col("ts_ns") < limit).withColumn("at", F.col("ts_ns")).withColumn("_old", F.lit(False))
        rows = _dealt(state.taken("carried", carried).withColumn("_old", F.lit(True)).unionByName(ready))
        held = Ordered(rows, [key], policy=policy).lead("next_ts", "ts_ns").done()
        until = F.least(F.coalesce("next_ts", limit), F.col("ts_ns") + max_carry_ns)
        held = cut_lineage(held.select(key, "ts_ns", "seq", "value", "at", "_old", "next_ts", until.alias("until")))
        last = held.filter("next_ts is null").filter(F.col("until") < F.col("ts_ns") + max_carry_ns)
        state.leave("carried", last.select(key, "ts_ns", "seq", "value", F.col("until").alias("at")))

        # A value that had been counted to its end before adds nothing; a new row is counted in its bin in any case.
        touched = touch_bins(held.filter("not _old or until > at"), bin_ns, "at")
        counted = (~F.col("_old") & (F.col("first_bin") == F.col("first"))).cast("long")
        parts = touched.select(
            key, "first_bin", "last_bin", counted.alias("count"), F.col("value").alias("min"), F.col("value").alias("max"),
            (F.col("value") * F.col("overlap")).alias("weighted"), F.col("overlap").alias("weight"),
        )
        sums = parts.unionByName(state.taken("open", opened)).groupBy(key, "first_bin", "last_bin")
        sums = sums.agg(*[f(c).alias(c) for c, f in (("count", F.sum), ("min", F.min), ("max", F.max), ("weighted", F.sum), ("weight", F.sum))])
        sums = cut_lineage(sums)
        done = F.col("last_bin") < bucket(limit, bin_ns)
        state.leave("open", sums.filter(F.coalesce(~done, F.lit(True))))
        avg = F.when(F.col("first_bin") < F.col("last_bin"), F.col("min")).otherwise(F.col("weighted") / F.col("weight"))
        closed = sums.filter(done).select(key, "first_bin", "last_bin", "count", "min", "max", avg.alias("avg"))
        closed.write.mode("overwrite").parquet(f"{root}/bins/batch={batch_id}")
        state.leave_mark(mark)
        state.forget("mark", "pending", "carried", "open")

    return each_batch(events, checkpoint, step, available_now)


_SUMS = struct(first_bin=LONG, last_bin=LONG, count=LONG, min=DOUBLE, max=DOUBLE, weighted=DOUBLE, weight=DOUBLE)


def ingest_batches(
    events: DataFrame,
    root: str,
    checkpoint: str,
    gate: IntervalGate | None = None,
    roll: PartitionRoll | None = None,
    grid: GridChange | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
    available_now: bool = True,
) -> StreamingQuery:
    """Gate, lay out and store a stream of events, with the same tables as `jobs.ingest`.

    The gate folds a micro-batch in the order of its clock, the layout the admitted rows in time order; both go
    on from the state that the batch before left for the series, and large series are sliced in both.
    """
    gate, layout = gate or IntervalGate(), Chain(roll or PartitionRoll(), grid or GridChange())
    by_arrival, key = (gate.ts, "seq"), T.StructType([events.schema["series"]])
    entry = lambda kernel: T.StructType([*key.fields, T.StructField(ENTRY, kernel.state)])

    def step(batch: DataFrame, batch_id: int) -> None:
        state = Handover(batch.sparkSession, root, batch_id)

        def go_on(rows: DataFrame, kernel, name: str, order) -> DataFrame:
            before = state.taken(name, entry(kernel))
            folded = cut_lineage(fold(rows, ["series"], kernel, order, policy=policy, entry=before, exits=True))
            state.leave(name, _replaced(before, exit_states(folded, ["series"], order), ["series"]))
            return folded.drop(EXIT)

        gated = go_on(batch, gate, "gate", by_arrival)
        stored = go_on(gated.filter("admitted"), layout, "layout", ("ts_ns", "seq"))
        write_events(stored.withColumn("ts_lsp", offset_in_partition()), root, batch_id)
        told = gated.filter("report and not admitted").withColumn("ema", F.col("report_ema")).withColumn("emd", F.col("report_emd"))
        write(with_part(told), root, "receive_interval", batch_id)
        state.forget("gate", "layout")

    return each_batch(events, checkpoint, step, available_now)


def silence_batches(
    log: DataFrame,
    root: str,
    checkpoint: str,
    key: str = "addr",
    silent_ns: int = 20 * SECOND,
    critical_ns: int = 10 * SECOND,
    policy: SlicePolicy = DEFAULT_POLICY,
    available_now: bool = True,
) -> StreamingQuery:
    """Alarms of a stream of status rows, to `root/alarms`, each once the newest row has passed its time.

    State: the last row of every key. An alarm that a later row still precedes is not raised; one that
    was raised before stays, also if a late row would have prevented it. Rows before their key's last are left out.
    """
    last_of = T.StructType([log.schema[key], *struct(ts_ns=LONG).fields])

    def step(batch: DataFrame, batch_id: int) -> None:
        state = Handover(batch.sparkSession, root, batch_id)
        before = state.mark()
        new = batch.select(key, "ts_ns").filter("ts_ns is not null")
        mark = _settled_to(new, before, 0)
        last = state.taken("last", last_of)
        known = last.select(F.col(key).alias("_key"), F.col("ts_ns").alias("_last"))
        new = new.join(known, F.col(key).eqNullSafe(F.col("_key")), "left").filter("_last is null or ts_ns >= _last").select(key, "ts_ns")
        rows = _dealt(last.withColumn("_old", F.lit(True)).unionByName(new.withColumn("_old", F.lit(False))))
        state.leave("last", rows.groupBy(key).agg(F.max("ts_ns").alias("ts_ns")))
        held = Ordered(rows, [key], ("ts_ns", "_old"), policy=policy).lead("_next", "ts_ns").done()
        stages = F.array(
            F.struct(F.lit("shutdown").alias("alarm"), (F.col("ts_ns") + silent_ns).alias("alarm_ts_ns")),
            F.struct(F.lit("critical").alias("alarm"), (F.col("ts_ns") + silent_ns + critical_ns).alias("alarm_ts_ns")),
        )
        due = held.select(key, "_old", F.coalesce("_next", F.lit(mark).cast("long")).alias("_until"), F.inline(stages)).filter("alarm_ts_ns < _until")
        if before is not None:
            due = due.filter(~F.col("_old") | (F.col("alarm_ts_ns") >= before))
        due.select(key, "alarm", "alarm_ts_ns").write.mode("overwrite").parquet(f"{root}/alarms/batch={batch_id}")
        state.leave_mark(mark)
        state.forget("mark", "last")

    return each_batch(log, checkpoint, step, available_now)
