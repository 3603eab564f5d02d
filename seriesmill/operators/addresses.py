"""Channel address history, address lookup and search answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.joins import join_sized
from seriesmill.operators.slicing import DEFAULT_POLICY, HotKeys, Ordered, SlicePolicy
from seriesmill.schemas import SECOND

CHANNEL = ("facility", "channel")


def address_history(
    log: DataFrame, keys: Sequence[str] = CHANNEL, hot: HotKeys | None = None, policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Runs of one address per channel; only the last run of a channel is not archived.

    `log` has the keys, `addr`, `responseaddr`, `tsmod` and `seq`. A null address is a value like
    any other, and a return to an earlier address starts a new run.
    """
    at = ("tsmod", "seq")
    rows = Ordered(log, keys, order=at, hot=hot, policy=policy)
    rows.lag("_before", F.struct("addr")).lead("_after", "tsmod")
    starts = F.col("_before").isNull() | ~F.col("_before.addr").eqNullSafe(F.col("addr"))
    rows.with_column("_starts", starts.cast("long")).running_sum("run", F.col("_starts"))
    latest = F.struct(*at)
    return (
        rows.done()
        .groupBy(*keys, "run")
        .agg(
            F.first("addr").alias("addr"),
            F.max_by("responseaddr", latest).alias("responseaddr"),
            F.min("tsmod").alias("tscreate"),
            F.max("tsmod").alias("tsmod"),
            F.min(F.when(F.col("_after").isNull(), 0).otherwise(1)).alias("archived"),
        )
    )


def late_rows(current: DataFrame, log: DataFrame, keys: Sequence[str] = CHANNEL) -> DataFrame:
    """Log rows from before the last row of their channel's open run."""
    open_runs = current.filter("archived = 0").select(*keys, F.col("tsmod").alias("_open"))
    return log.join(open_runs, list(keys)).filter("tsmod < _open").drop("_open")


def update_history(current: DataFrame, log: DataFrame, raw: DataFrame, keys: Sequence[str] = CHANNEL, **how) -> DataFrame:
    """The whole history after a further batch that may have late rows.

    Channels with late rows are made anew from `raw`, all their log rows; the others are extended.
    """
    late = late_rows(current, log, keys).select(*keys).distinct()
    on_time = extend_history(current, log.join(late, list(keys), "left_anti"), keys, **how)
    anew = address_history(raw.join(late, list(keys), "left_semi"), keys, **how)
    kept = current.join(late, list(keys), "left_anti").join(on_time.select(*keys, "run"), [*keys, "run"], "left_anti")
    return kept.unionByName(on_time).unionByName(anew)


def extend_history(current: DataFrame, log: DataFrame, keys: Sequence[str] = CHANNEL, **how) -> DataFrame:
    """Apply a further batch of log rows to the history: the unarchived run of a channel goes on.

    `current` is the result of an earlier call. Only channels named in the batch are recomputed,
    from their open run and the new rows. Gives the changed and new runs; archived ones stay as
    they are. Rows older than their channel's open run are left out, since runs do not say what lay
    between their rows: see `late_rows` and `update_history`.
    """
    log = log.join(late_rows(current, log, keys).select(*keys, "tsmod", "seq"), [*keys, "tsmod", "seq"], "left_anti")
    touched = log.select(*keys).distinct()
    open_runs = current.filter("archived = 0").join(touched, list(keys), "left_semi")
    first = open_runs.select(
        *keys, "addr", "responseaddr", F.col("tsmod"), F.lit(-1).cast("long").alias("seq"), F.col("tscreate").alias("_created"),
        F.col("run").alias("_run"),
    )
    new = log.select(
        *keys, "addr", "responseaddr", "tsmod", "seq", F.lit(None).cast("long").alias("_created"), F.lit(None).cast("long").alias("_run")
    )
    merged = first.unionByName(new)
    runs = address_history(merged.drop("_created", "_run"), keys, **how)
    base = first.select(*keys, "_created", (F.col("_run") - 1).alias("_base"))
    return runs.join(base, list(keys), "left").select(
        *keys,
        (F.col("run") + F.coalesce("_base", F.lit(0))).alias("run"),
        "addr",
        "responseaddr",
        F.when((F.col("run") == 1) & F.col("_created").isNotNull(), F.col("_created")).otherwise(F.col("tscreate")).alias("tscreate"),
        "tsmod",
        "archived",
    )


def match_addresses(left: DataFrame, right: DataFrame, keys: Sequence[str] = CHANNEL) -> DataFrame:
    """Rows of `left` with an equal address in `right`, null equal to null."""
    cond = left["addr"].eqNullSafe(right["addr"])
    for k in keys:
        cond = cond & (left[k] == right[k])
    return left.join(right, cond, "left_semi")


def latest_addresses(log: DataFrame, keys: Sequence[str] = CHANNEL) -> DataFrame:
    """Latest known address of every channel; searches without answer do not count."""
    at = F.struct("tsmod", "seq")
    found = log.filter("addr is not null").groupBy(*keys)
    return found.agg(F.max_by("addr", at).alias("addr"), F.max("tsmod").alias("tsmod"))


def latest_address(log: DataFrame, facility: str, channel: str) -> DataFrame:
    return latest_addresses(log.filter((F.col("facility") == facility) & (F.col("channel") == channel)))


def find_addresses(channels: DataFrame, log: DataFrame, keys: Sequence[str] = CHANNEL) -> DataFrame:
    """Every requested channel with its latest address, null when there is none."""
    return channels.join(latest_addresses(log, keys), list(keys), "left")


def all_answered(channels: DataFrame, answers: DataFrame) -> DataFrame:
    """One row: the sizes of request and answer, which must agree."""
    sizes = channels.select(F.lit(1).alias("asked"), F.lit(0).alias("answered")).unionByName(
        answers.select(F.lit(0).alias("asked"), F.lit(1).alias("answered"))
    )
    return sizes.agg(F.sum("asked").alias("asked"), F.sum("answered").alias("answered")).withColumn(
        "complete", F.col("asked") == F.col("answered")
    )


def drop_gateways(
    found: DataFrame, gateways: DataFrame, columns: Sequence[str] = ("response_addr", "addr"), gateway: str = "gateway"
) -> DataFrame:
    """Drop results whose response or resolved address is a gateway; null passes."""
    for c in columns:
        listed = gateways.select(F.col(gateway).alias(c)).distinct()
        found = join_sized(found, listed, [c], "left_anti")
    return found


def _request_answer_rows(requests: DataFrame, answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    asked = requests.select(
        *keys, "ts_ns", "seq", F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("response_addr"),
        F.lit(None).cast("string").alias("addr"),
    )
    answered = answers.select(*keys, "ts_ns", "seq", F.lit(1).alias("_kind"), "response_addr", "addr")
    return asked.unionByName(answered)


def match_answers(
    requests: DataFrame,
    answers: DataFrame,
    keys: Sequence[str] = ("search_id",),
    limit_ns: int = SECOND * 8 // 10,
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """First answer at or after each request, within the limit.

    Requests and answers go through one ordered pass, so the work is linear in their number; a
    join on the key would pair every request with every answer of it. Without an answer the
    addresses are null and `dt` is the limit.
    """
    rows = _request_answer_rows(requests, answers, keys)
    answer = F.when(F.col("_kind") == 1, F.struct("ts_ns", "response_addr", "addr"))
    rows = Ordered(rows, keys, order=("ts_ns", "_kind", "seq"), hot=hot, policy=policy).next_match("_answer", answer).done()
    dt = F.col("_answer.ts_ns") - F.col("ts_ns")
    hit = F.coalesce(dt <= limit_ns, F.lit(False))
    return rows.filter("_kind = 0").select(
        *keys,
        "ts_ns",
        "seq",
        F.when(hit, F.col("_answer.response_addr")).alias("response_addr"),
        F.when(hit, F.col("_answer.addr")).alias("addr"),
        F.when(hit, dt).otherwise(F.lit(limit_ns)).alias("dt"),
        hit.alias("answered"),
    )


def duplicate_answers(
    requests: DataFrame,
    answers: DataFrame,
    keys: Sequence[str] = ("search_id",),
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Per key, the answers that follow another answer instead of a request."""
    rows = _request_answer_rows(requests, answers, keys)
    rows = Ordered(rows, keys, order=("ts_ns", "_kind", "seq"), hot=hot, policy=policy).lag("_before", "_kind").done()
    again = (F.col("_kind") == 1) & (F.col("_before") == 1)
    return rows.groupBy(*keys).agg(F.count_if(again).alias("duplicates"))
