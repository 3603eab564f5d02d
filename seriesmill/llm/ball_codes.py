"""Vector codes by product quantisation, with codebooks from ball k-means in whole numbers.

A vector is cut into equal parts; each part position has a codebook. In every round a part knows
the entry it had before. All parts of an entry form a ball around it:

* the largest distance to the entry is the ball's radius, and only entries within twice that
  distance are its neighbours;
* a part nearer to its entry than half the way to the nearest neighbour is in the stable core
  and keeps its entry without any further distance;
* the others lie in rings: a part at distance d can only change to entries within 2 d of its own,
  so neighbours are sorted by distance and every ring is compared with its own first few.

Distances are squared and whole, so all comparisons are exact: |c - e|^2 > 4 |x - c|^2 leaves x
with c, and ties go to the lower index. A round is one job; its tasks write their rows and one
partial sum per entry, so the driver only sees the codebooks (parts x entries rows).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import drop_folder, scratch_dir, stored

# Rows that a task handles together; balls are formed within them.
BLOCK_ROWS = 32_768


def whole_vectors(vectors: DataFrame, scale: int, carry: Sequence[str], vector: str) -> DataFrame:
    """`carry` columns and `vec`, every component x as floor(scale * x), of the rows whose vector is whole.

    Left out: null and empty vectors, and those with a null, non-finite or too large component
    (squared distances have to fit into 64 bits).
    """
    most = float(1 << 62)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(carry)).cast(pa.large_list(pa.float64()))
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            flat = lists.flatten()
            missing = np.asarray(flat.is_null())
            with np.errstate(all="ignore"):
                x = np.floor(np.asarray(flat.fill_null(0)) * scale)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                limit = np.floor(np.sqrt(most / np.maximum(sizes, 1)) / 2)
                bad = missing | ~np.isfinite(x) | (np.abs(x) >= limit[owner])
            keep = sizes > 0
            keep[owner[bad]] = False
            ints = x[keep[owner]].astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes[keep])]).astype(np.int32)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).filter(mask) for i in range(len(carry))], pa.ListArray.from_arrays(pa.array(ends), pa.array(ints))], names=[*carry, "vec"]
            )

    fields = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in carry)
    return vectors.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{vector}`").cast("array<double>")).mapInArrow(run, f"{fields}, vec array<long>")


def nearest_of_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry, ties to the lower index."""
    code, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    norms = (entries * entries).sum(1)
    for at in range(0, len(x), 4096):
        own = x[at : at + 4096]
        d = _products(own, entries) * -2 + norms
        code[at : at + 4096] = c = d.argmin(1)
        best[at : at + 4096] = d[np.arange(len(own)), c] + (own * own).sum(1)
    return code, best


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole rows, by floating point where that is exact."""
    most = int(max(np.abs(a).max(initial=0), 1)) * int(max(np.abs(b).max(initial=0), 1)) * a.shape[1]
    if most < 1 << 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Balls:
    """The entries of one codebook, each with the others sorted by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        norms = (entries * entries).sum(1)
        self.apart = norms[:, None] + norms[None, :] - 2 * _products(entries, entries)
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.apart, self.order, 1)

    def assign(self, x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of every part and its squared distance, from the entry it had."""
        own = x - self.entries[code]
        best = (own * own).sum(1)
        code, by = code.copy(), np.argsort(code, kind="stable")
        begins = np.searchsorted(code[by], np.arange(len(self.entries) + 1))
        for j in range(len(self.entries)):
            ball = by[begins[j] : begins[j + 1]]
            if not len(ball):
                continue
            neighbours = int(np.searchsorted(self.sorted[j], 4 * best[ball].max(), "right"))
            if neighbours < 2:  # none but itself: all of the ball is stable
                continue
            reach = np.searchsorted(self.sorted[j, :neighbours], 4 * best[ball], "right")
            ring = np.ceil(np.log2(reach)).astype(np.int64)  # 0: the stable core
            for r in np.unique(ring[ring > 0]).tolist():
                rows = ball[ring == r]
                near = np.sort(self.order[j, : min(1 << r, neighbours)])
                c, d = nearest_of_all(x[rows], self.entries[near])
                code[rows], best[rows] = near[c], d
        return code, best


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), dtype=np.int64).reshape(-1, width)


def _assigned(table: pa.Table, books: list[Balls], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, parts = _matrix(table.column("vec"), width * len(books)), len(books)
    before = _matrix(table.column("codes"), parts) if table.column("codes").null_count == 0 else None
    codes, error = np.empty((len(x), parts), np.int64), np.zeros(len(x), np.int64)
    for p, book in enumerate(books):
        own = np.ascontiguousarray(x[:, p * width : (p + 1) * width])
        codes[:, p], d = nearest_of_all(own, book.entries) if before is None else book.assign(own, before[:, p])
        error += d
    return x, codes, error


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def _round(rows: DataFrame, books: list[np.ndarray], carry: Sequence[str], folder: str) -> DataFrame:
    """Assign every part; the folder gets the rows with their codes and, apart from them, each task's sums."""
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    schema = f"{fields}, vec array<long>, codes array<long>, part int, entry int, times long, sums array<long>, of string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, balls = books[0].shape[1], [Balls(b) for b in books]
        times, sums, types = np.zeros((len(books), len(books[0])), np.int64), np.zeros((len(books), len(books[0]), width), np.int64), None
        for table in _blocks(batches):
            x, codes, _ = _assigned(table, balls, width)
            types = [table.column(c).type for c in carry]
            for p in range(len(books)):
                by = np.argsort(codes[:, p], kind="stable")
                used, first, n = np.unique(codes[by, p], return_index=True, return_counts=True)
                times[p, used] += n
                sums[p, used] += np.add.reduceat(x[by, p * width : (p + 1) * width], first, axis=0)
            n = len(x)
            none = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            own = [table.column(c).combine_chunks() for c in carry]
            yield pa.RecordBatch.from_arrays([*own, _lists(x), _lists(codes), *none, pa.array(["rows"] * n)], names=names)
        if types is not None:
            part, entry = np.nonzero(times)
            none = [pa.nulls(len(part), t) for t in (*types, pa.list_(pa.int64()), pa.list_(pa.int64()))]
            own = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(times[part, entry]), _lists(sums[part, entry])]
            yield pa.RecordBatch.from_arrays([*none, *own, pa.array(["sums"] * len(part))], names=names)

    names = [*carry, "vec", "codes", "part", "entry", "times", "sums", "of"]
    rows.mapInArrow(run, schema).write.partitionBy("of").option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(schema).parquet(folder)


def _moved(books: list[np.ndarray], written: DataFrame) -> list[np.ndarray]:
    """Every used entry at the floor of its parts' mean."""
    width, books = books[0].shape[1], [b.copy() for b in books]
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    # At most one row per part and entry.
    for row in written.filter("of = 'sums'").groupBy("part", "entry").agg(F.sum("times").alias("times"), *totals).collect():
        books[row["part"]][row["entry"]] = [row[f"s{i}"] // row["times"] for i in range(width)]
    return books


def ball_codes(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, key: str = "vec_id", vector: str = "embedding", carry: Sequence[str] = ()
) -> tuple[DataFrame, list[list[list[int]]]]:
    """The rows with a whole vector: key, `carry`, `codes` (entry per part) and `error` (squared distances summed); and the codebooks.

    Codebooks start as the parts of the `entries` rows with the smallest keys (null keys last, then
    by vector), fewer if there are fewer rows. Null, empty and non-finite vectors and those of
    another length than the first row's are left out. Repeated rows count each. Equal entries: the
    lower index is used. An empty table gives no rows and no codebooks. `parts` has to divide the length.
    """
    spark, names = vectors.sparkSession, [key, *carry]
    if {"codes", "error"} & {c.lower() for c in names}:
        raise ValueError("the result has columns codes and error of its own")
    columns = [f"c{i}" for i in range(len(names))]
    given = vectors.select(*[F.col(f"`{c}`").alias(own) for c, own in zip(names, columns)], F.col(f"`{vector}`").alias("given"))
    whole = stored(whole_vectors(given, scale, columns, "given"), "vectors")
    order = [F.col(columns[0]).asc_nulls_last(), F.col("vec")]
    first = whole.orderBy(*order).limit(1).collect()
    if not first:
        return whole.select(*columns, F.array().cast("array<long>").alias("codes"), F.lit(0).cast("long").alias("error")).toDF(*names, "codes", "error"), []
    size = len(first[0]["vec"])
    if size % parts:
        raise ValueError(f"vectors of {size} components have no {parts} equal parts")
    width = size // parts
    whole = whole.filter(F.size("vec") == size)
    seeds = np.array([r["vec"] for r in whole.orderBy(*order).select("vec").limit(entries).collect()], np.int64)
    books = [np.ascontiguousarray(seeds[:, p * width : (p + 1) * width]) for p in range(parts)]
    rows, folder = whole.withColumn("codes", F.lit(None).cast("array<long>")), None
    for _ in range(rounds):
        last, folder = folder, scratch_dir(spark, "balls")
        written = _round(rows, books, columns, folder)
        books = _moved(books, written)
        rows = written.filter("of = 'rows'").select(*columns, "vec", "codes")
        if last:
            drop_folder(spark, last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(b) for b in books]
        for table in _blocks(batches):
            _, codes, error = _assigned(table, balls, width)
            yield pa.RecordBatch.from_arrays([*[table.column(c).combine_chunks() for c in columns], _lists(codes), pa.array(error)], names=[*columns, "codes", "error"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    coded = rows.mapInArrow(run, f"{fields}, codes array<long>, error long")
    coded = stored(coded, "codes").toDF(*names, "codes", "error")
    if folder:
        drop_folder(spark, folder)
    return coded, [b.tolist() for b in books]
