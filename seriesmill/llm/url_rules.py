"""Allow and block rules for URLs, matched by a sort-merge range join.

The key of a host is its labels from the last to the first, each closed by `\\x01`, so the key of a
host is a prefix of the keys of its subdomains: a rule covers the interval of keys from its own
up to (not with) the same key ending in `\\x02`. Intervals of hosts are nested or apart. URLs are
range partitioned and sorted by key and path; every rule goes to the partitions that its interval
meets. A sweep over a partition keeps a stack of the rules whose interval holds the current key
and asks only these for their path.

A host may hold any share of the URLs: the range is cut within a host by path, and within one
URL by row number. Per partition of URLs only its first and last key come to the driver.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.llm.common import ascii_lower, small_batches, stored

RULE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])
# Below every character of a key: what a host's own URLs sort by, before its subdomains.
OWN = "\x00"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without `://` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels reversed, each closed by `\\x01`; `\\x00` to `\\x02` in a host are escaped."""
    safe = host
    for char, code in (("\x02", "\x02c"), ("\x01", "\x02b"), ("\x00", "\x02a")):
        safe = F.replace(safe, F.lit(char), F.lit(code))
    labels = F.reverse(F.split(safe, r"\."))
    return F.concat(F.array_join(labels, "\x01"), F.lit("\x01"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
    partitions: int | None = None,
) -> DataFrame:
    """Every row of `pages` with host, path, the rule that holds (or null) and the verdict.

    `rules` has host, path and verdict. A rule fits its host and all subdomains if the URL's path
    starts with the rule's. Of several, the longest (host and path together) holds, then the one of
    the longer host; of equal rules that disagree, `block` holds. Without a rule: `default`.
    A null URL or one without `://` has empty host and path, which no rule with a host fits. Rules
    with a null are left out. Repeated rows of `pages` are judged each for itself; null ids stay
    null; an empty table gives an empty one. Other columns are not read, so their names may clash.
    """
    spark = pages.sparkSession
    small_batches(spark, 10_000)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(F.col("_url"))
    urls = (
        pages.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{url_column}`").alias("_url"))
        .withColumn("_row", F.monotonically_increasing_id())
        .select("_id", "_row", host.alias("host"), path.alias("path"))
        .withColumn("key", F.concat(host_key(F.col("host")), F.lit(OWN), "path"))
    )
    placed = stored(urls.repartitionByRange(n, "key", "_row").withColumn("part", F.spark_partition_id()), "urls")
    spans = placed.groupBy("part").agg(F.min("key"), F.max("key")).orderBy("part").collect()
    parts, lows, highs = [r[0] for r in spans], [r[1] for r in spans], [r[2] for r in spans]
    out_type = pages.schema[id_column].dataType.simpleString()
    schema = f"_id {out_type}, host string, path string, rule string, verdict string"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each rule once for every partition that its interval meets."""
        for batch in batches:
            rows = {"part": [], "key": [], "host": [], "path": [], "verdict": []}
            for key, h, p, v in zip(*[c.to_pylist() for c in batch.columns]):
                first, last = bisect_left(highs, key), bisect_left(lows, key[:-1] + "\x02")
                for part in parts[first:last]:
                    for name, value in zip(rows, (part, key, h, p, v)):
                        rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("part", pa.int32()), *[(c, pa.string()) for c in list(rows)[1:]]]))

    ruled = (
        rules.select("host", "path", "verdict")
        .na.drop()
        .distinct()
        .select(host_key(ascii_lower(F.col("host"))).alias("key"), "host", "path", "verdict")
        .mapInArrow(spread, "part int, key string, host string, path string, verdict string")
    )
    both = placed.select("part", "key", F.lit(1).alias("kind"), "_id", "host", "path", F.lit(None).cast("string").alias("verdict")).unionByName(
        ruled.select("part", "key", F.lit(0).alias("kind"), F.lit(None).cast(out_type).alias("_id"), "host", "path", "verdict")
    )
    swept = (
        both.repartitionByRange(max(len(parts), 1), "part")
        .sortWithinPartitions("part", "key", "kind")
        .mapInArrow(lambda batches: sweep(batches, default), schema)
    )
    return swept.select(F.col("_id").alias(id_column), "host", "path", "rule", "verdict")


def sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Walk sorted rules (kind 0) and URLs (kind 1) with a stack of the rules' hosts in force."""
    part, stack = None, []  # of (key of the host, host, {path: verdict}, lengths of the paths)
    for batch in batches:
        ids, hosts, paths, names, verdicts = [], [], [], [], []
        columns = [batch.column(c).to_pylist() for c in ("part", "key", "kind", "host", "path", "verdict")]
        for at, (p, key, kind, host, path, verdict) in enumerate(zip(*columns)):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host, {}, set()))
                known = stack[-1][2]
                known[path] = "block" if "block" in (verdict, known.get(path)) else verdict
                stack[-1][3].add(len(path))
                continue
            best = None
            for _, rule_host, known, lengths in stack:
                for length in lengths:
                    if length <= len(path) and (found := known.get(path[:length])) is not None:
                        rank = (len(rule_host) + length, len(rule_host))
                        if best is None or rank > best[0]:
                            best = (rank, rule_host + path[:length], found)
            ids.append(at)
            hosts.append(host)
            paths.append(path)
            names.append(best[1] if best else None)
            verdicts.append(best[2] if best else default)
        text = lambda values: pa.array(values, pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id").take(pa.array(ids, pa.int64())), text(hosts), text(paths), text(names), text(verdicts)],
            names=["_id", "host", "path", "rule", "verdict"],
        )
