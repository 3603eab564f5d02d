"""Word windows that occur more than once anywhere, found by super-k-mer partitioning.

1. The minimiser of a window is the smallest hash among its runs of `seed` words. Consecutive
   windows with one minimiser are a super-k-mer; first only its place and minimiser are written.
   One of more than `LONGEST` windows (a text that repeats a few words) is cut into several.
2. A window can only repeat if its minimiser does, so super-k-mers whose minimiser occurs once go
   no further. That is most of them.
3. The others travel as one packed string (their words, a space between) to the bucket of their
   minimiser. Equal strings are combined before the shuffle.
4. In its bucket, the windows of all strings are sorted and counted.
5. A bucket of more than `HOT` windows is not put in one task: its strings are taken apart
   into digests of windows, counted with partial sums before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import small_batches, stored
from seriesmill.llm.segments import slices
from seriesmill.llm.shingles import chain, hash_words, split_batch
from seriesmill.llm.stars import attach, narrowed

HOT = 150_000
LONGEST = 512


def running_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every `size` consecutive values."""
    done, out = 1, values
    while done < size:
        step = min(done, size - done)
        out = np.minimum(out[: len(out) - step], out[step:]) if len(out) > step else out[:0]
        done += step
    return out


def super_kmers(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """Place of every super-k-mer: doc, text_hash, start (word), n (windows), mini, and whether it
    holds its minimiser more than once (`at_least` 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words, offsets = split_batch(batch.column(2))
                seeds = chain(hash_words(words), seed)
                minis = running_min(seeds, window - seed + 1)
                sizes = np.maximum(np.diff(offsets) - window + 1, 0)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                first = np.cumsum(sizes) - sizes
                local = np.arange(len(rows)) - first[rows]
                mini = minis[offsets[:-1][rows] + local]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (mini[1:] != mini[:-1])
                at = np.flatnonzero(new)
                begun = np.repeat(at, np.diff(np.append(at, len(rows))))
                new |= (np.arange(len(rows)) - begun) % LONGEST == 0
                at = np.flatnonzero(new)
                own = pa.array(rows[at])
                # The minimiser starts a window and the next window has it again: it is there twice.
                again = np.zeros(len(rows), bool)
                again[:-1] = ~new[1:] & (seeds[offsets[:-1][rows] + local][:-1] == mini[:-1])
                twice = np.logical_or.reduceat(again, at) if len(at) else again
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(own),
                        batch.column(1).take(own),
                        pa.array(local[at].astype(np.int32)),
                        pa.array(np.diff(np.append(at, len(rows))).astype(np.int32)),
                        pa.array(mini[at].view(np.int64)),
                        pa.array(1 + twice.astype(np.int32)),
                    ],
                    names=["doc", "text_hash", "start", "n", "mini", "at_least"],
                )

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, text_hash long, start int, n int, mini long, at_least int")


def packed_strings(rows: DataFrame, window: int) -> DataFrame:
    """The words of each listed super-k-mer as one string, with a digest that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2 << 20):
                out = [[] for _ in range(6)]
                texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
                for row, (text, places) in enumerate(zip(texts, batch.column("places").to_pylist())):
                    words = text.split()
                    for p in places:
                        string = b" ".join(words[p["start"] : p["start"] + p["n"] + window - 1])
                        name = hashlib.blake2b(string, digest_size=16).digest()
                        for column, value in zip(out, (row, p["start"], p["mini"], p["hot"], name, string)):
                            column.append(value)
                own = pa.array(out[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").take(own),
                        batch.column("text_hash").take(own),
                        pa.array(out[1], pa.int32()),
                        pa.array(out[2], pa.int64()),
                        pa.array(out[3], pa.bool_()),
                        pa.array(out[4], pa.binary()),
                        pa.array(out[5], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc", "text_hash", "start", "mini", "hot", "name", "string"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, text_hash long, start int, mini long, hot boolean, name binary, string string")


def windows_of(string: str, window: int) -> list[str]:
    """All windows of a packed string; `LONGEST` bounds their number."""
    ends = [i for i, c in enumerate(string) if c == " "] + [len(string)]
    begins = [0, *[e + 1 for e in ends[:-1]]]
    return [string[begins[i] : ends[i + window - 1]] for i in range(len(begins) - window + 1)]


def repeated_in_buckets(strings: DataFrame, window: int) -> DataFrame:
    """Sort the windows of each bucket; the strings with repeated windows: name, windows (positions)."""
    n = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def bucket(rows: list[tuple]) -> Iterator[tuple[bytes, list[int]]]:
        if len(rows) == 1 and rows[0][1] == 1 and rows[0][2].count(" ") < window:
            return  # a single window, once
        entries = sorted((w, k, i) for k, (_, _, s) in enumerate(rows) for i, w in enumerate(windows_of(s, window)))
        found: list[list[int]] = [[] for _ in rows]
        begin = 0
        for end in range(1, len(entries) + 1):
            if end == len(entries) or entries[end][0] != entries[begin][0]:
                same = entries[begin:end]
                if len(same) > 1 or rows[same[0][1]][1] > 1:
                    for _, k, i in same:
                        found[k].append(i)
                begin = end
        yield from ((rows[k][0], sorted(at)) for k, at in enumerate(found) if at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mini, rows = None, []
        pack = lambda pairs: pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.list_(pa.int32()))], names=["name", "windows"]
        )
        for batch in batches:
            done = []
            for m, *row in zip(*[batch.column(c).to_pylist() for c in ("mini", "name", "n", "string")]):
                if m != mini:
                    done.extend(bucket(rows) if rows else ())
                    mini, rows = m, []
                rows.append(tuple(row))
            yield pack(done)
        yield pack(list(bucket(rows)) if rows else [])

    dealt = strings.select("mini", "name", "n", "string").repartition(n, "mini").sortWithinPartitions("mini")
    return dealt.mapInArrow(run, "name binary, windows array<int>")


def repeated_in_hot_buckets(strings: DataFrame, window: int) -> DataFrame:
    """The same for strings of hot buckets, by 128-bit digests of single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n, string in zip(*[batch.column(c).to_pylist() for c in ("name", "n", "string")]):
                digests = [hashlib.blake2b(w.encode(), digest_size=16).digest() for w in windows_of(string, window)]
                size = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * size, pa.binary()), pa.array([n] * size, pa.int64()), pa.array(np.arange(size, dtype=np.int32)), pa.array(digests, pa.binary())],
                    names=["name", "n", "at", "digest"],
                )

    windows = strings.select("name", "n", "string").mapInArrow(run, "name binary, n long, at int, digest binary")
    often = windows.groupBy("digest").agg(F.sum("n").alias("times")).filter("times > 1").select("digest")
    return windows.join(often, "digest").groupBy("name").agg(F.collect_list("at").alias("windows"))


def repeated_windows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """Windows that occur elsewhere too, of documents that have any: doc, text_hash, starts (word positions)."""
    places = stored(super_kmers(docs, window, seed), "super-kmers")
    shared = places.groupBy("mini").agg(F.sum("at_least").alias("times"), F.sum("n").alias("size")).filter("times > 1")
    often = places.join(shared, "mini").select("doc", "text_hash", F.struct("start", "n", "mini", (F.col("size") > HOT).alias("hot")).alias("place"))
    listed = stored(often.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("places")), "listed")
    on = ["doc", "text_hash"]
    packed = stored(packed_strings(narrowed(docs, listed.select(*on), on).join(listed, on), window), "packed")
    strings = packed.groupBy("name").agg(F.count("*").alias("n"), F.min("mini").alias("mini"), F.min("hot").alias("hot"), F.min("string").alias("string"))
    found = repeated_in_buckets(strings.filter("not hot"), window).unionByName(repeated_in_hot_buckets(strings.filter("hot"), window))
    starts = packed.select("doc", "text_hash", "start", "name").join(found, "name")
    starts = starts.select("doc", "text_hash", F.explode(F.transform("windows", lambda w: w + F.col("start"))).alias("at"))
    return stored(starts.groupBy(*on).agg(F.collect_set("at").alias("starts")), "repeated")


def remove_repeats(docs: DataFrame, window: int = 35, seed: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's key, n_words, n_removed and kept: the words not covered by a window of `window`
    words whose sequence also starts elsewhere, joined by one space.

    All rows count, so every row of a repeated one loses the windows they share; the first
    occurrence is not spared. A null, empty or shorter text has no windows; null gives no words and
    an empty kept. Rows with a null key are rows like others. An empty table gives an empty one.
    Other columns are not read. Within, a row is told by the 64-bit hashes of its key and of its text;
    rows that agree in both share their places.
    """
    if not 1 <= seed <= window:
        raise ValueError("seed must be from 1 to window")
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    own_key = F.col(f"`{key}`")
    rows = docs.select(own_key.alias("key"), F.xxhash64(own_key).alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    found = repeated_windows(rows.drop("key"), window, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                counts, removed, kept = [], [], []
                texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
                for own, starts in zip(texts, batch.column("starts").to_pylist()):
                    words = own.split()
                    counts.append(len(words))
                    if starts:
                        depth = np.zeros(len(words) + 1, np.int64)
                        np.add.at(depth, starts, 1)
                        np.add.at(depth, np.array(starts) + window, -1)
                        stays = np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()
                        words = [words[i] for i in stays]
                    removed.append(counts[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "n_removed", "kept"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    joined = attach(rows, found, ["doc", "text_hash"]).select("key", "text", "starts")
    return joined.mapInArrow(run, f"key {kind}, n_words long, n_removed long, kept string").withColumnRenamed("key", key)
