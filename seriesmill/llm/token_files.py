"""Token ids in flat files with 64-bit document offsets, and reading them back.

A corpus is a folder in the shared file system. Each partition of the key order has three files:

* `.tokens`: the ids, flat, little-endian unsigned 16 bit, or 32 bit for larger vocabularies;
* `.offsets`: little-endian unsigned 64 bit, one per document and one more, where each document
  begins in `.tokens`, counted in ids;
* `.keys`: the document keys, an Arrow file with one column.

The manifest (one row per partition) has the sizes; the prefix sums of the token counts are the
partitions' bases, so a document's place in the corpus is base plus offset. Files are written
under names of the task attempt and listed by the attempts that succeeded, so a lost executor
leaves at most unlisted files. Readers map local files into memory and take byte ranges elsewhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from seriesmill.llm.common import scratch_dir, small_batches, stored
from seriesmill.llm.segments import encoder, slices

MANIFEST = "part int, path string, n_docs long, n_tokens long, width int"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)


def open_data(uri: str) -> pa.NativeFile:
    where, path = file_system(uri)
    return pa.memory_map(path) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(path)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text", partitions: int | None = None
) -> DataFrame:
    """Write the ids of `docs` in ascending key order to `folder`; the manifest with each partition's base.

    A null or empty text is the end id alone. Null keys come first; rows with one key are ordered
    by a hash of their text, and repeated rows are written each. An empty table writes no file.
    Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))
    ordered = rows.repartitionByRange(n, F.col("_key").asc_nulls_first(), F.xxhash64("_text"))
    ordered = ordered.sortWithinPartitions(F.col("_key").asc_nulls_first(), F.xxhash64("_text"))
    where, root = file_system(folder)
    where.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, coder, files = TaskContext.get(), encoder(tokenizer), None
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        where, root = file_system(folder)
        at = n_docs = 0
        for whole in batches:
            if not len(whole):
                continue
            if files is None:
                where.create_dir(root, recursive=True)
                files = [where.open_output_stream(f"{root}/{name}.{kind}") for kind in ("tokens", "offsets", "keys")]
                keys = pa.ipc.new_file(files[2], pa.schema([whole.schema.field(0)]))
                files[1].write(np.zeros(1, "<u8").tobytes())
            for batch in slices(whole):
                ids, begins = coder.encode(batch.column(1))
                closed = np.insert(ids, begins[1:], ids.dtype.type(end_id))
                files[0].write(closed.tobytes())
                files[1].write((at + begins[1:] + np.arange(1, len(begins))).astype("<u8").tobytes())
                keys.write_batch(batch.select([0]))
                at, n_docs = at + len(closed), n_docs + len(batch)
        if files is not None:
            keys.close()
            for f in files:
                f.close()
            made = {"part": [task.partitionId()], "path": [f"{folder}/{name}"], "n_docs": [n_docs], "n_tokens": [at], "width": [coder.dtype.itemsize]}
            types = [("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())]
            yield pa.RecordBatch.from_pydict(made, pa.schema(types))

    manifest = stored(ordered.mapInArrow(write, MANIFEST), "manifest")
    # One row per partition: their number is bounded by `partitions`, whatever the data.
    bases = F.coalesce(F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return manifest.withColumn("base", bases)


def read_tokens(spark: SparkSession, manifest: DataFrame, key_type: T.DataType, key: str = "doc_id") -> DataFrame:
    """One row per document from the files: key, start (ids before it in the corpus), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_data(row["path"] + ".offsets") as f:
                    offsets = np.frombuffer(f.read_buffer(), "<u8").astype(np.int64)
                with open_data(row["path"] + ".tokens") as tokens, open_data(row["path"] + ".keys") as keys:
                    width, done = row["width"], 0
                    reader = pa.ipc.open_file(keys)
                    for k in range(reader.num_record_batches):
                        own = reader.get_batch(k).column(0)
                        ends = offsets[done : done + len(own) + 1]
                        tokens.seek(int(ends[0]) * width)
                        ids = np.frombuffer(tokens.read_buffer(int(ends[-1] - ends[0]) * width), f"<u{width}")
                        local = (ends - ends[0]).tolist()
                        sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(local, local[1:])]
                        done += len(own)
                        yield pa.RecordBatch.from_arrays(
                            [own, pa.array(ends[:-1] + row["base"]), pa.array(np.diff(ends)), pa.array(sums, pa.int64())],
                            names=["_key", "start", "n_tokens", "ids_crc32"],
                        )

    n = max(manifest.count(), 1)
    schema = f"_key {key_type.simpleString()}, start long, n_tokens long, ids_crc32 long"
    return manifest.repartition(n, "part").mapInArrow(read, schema).withColumnRenamed("_key", key)


def token_corpus(docs: DataFrame, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write `docs` to a new folder beside the checkpoints and read every document back."""
    spark = docs.sparkSession
    manifest = write_tokens(docs, scratch_dir(spark, "tokens"), tokenizer, end_id, key, text)
    return read_tokens(spark, manifest, docs.schema[key].dataType, key)
