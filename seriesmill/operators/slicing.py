"""Ordered operators that survive a key holding a large share of all rows.

A plain `Window.partitionBy(key)` puts all rows of a key into one task. Here the keys that are
too large for that are found first (a map-side combined count), their rows are cut by rank into
slices of similar size, and windows run per (key, slice). What a slice needs from its
neighbours comes from a small table with one row per slice of a large key. Keys of ordinary
size keep a single slice and a plain window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.session import cut_lineage, small_table

SLICE = "_slice"


@dataclass(frozen=True)
class SlicePolicy:
    """When a key is cut up, and how finely.

    `max_rows` is the number of rows of one key a task may take. It grows where needed to keep
    the number of slices, and with it every broadcast made here, below about `3 * max_slices`.
    """

    max_rows: int = 4_000_000
    max_slices: int = 10_000


DEFAULT_POLICY = SlicePolicy()


def join_small(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe join to a table whose size is bounded by the slice policy."""
    renamed = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(F.broadcast(renamed), cond, how).drop(*[f"_k_{k}" for k in keys])


@dataclass
class HotKeys:
    """The keys to cut up, with the place in the order (time, then tie breaker) at which every slice begins."""

    keys: tuple[str, ...]
    ts: str
    tie: str | None = None
    table: DataFrame | None = None
    n_slices: int = 0
    most_cuts: int = 0

    def __bool__(self) -> bool:
        return self.table is not None

    def _passed(self, cut_t: str, cut_s: str, most: int) -> Column:
        """How many of up to `most` cuts are at or before the row, by halving: steps from large to small are taken while the cut there is not past the row."""
        ts, tie = F.col(self.ts), F.coalesce(F.col(self.tie), F.lit(LOWEST)) if self.tie else F.lit(LOWEST)

        def go_on(at: Column, step: Column) -> Column:
            t, s = F.get(cut_t, at + step - 1), F.get(cut_s, at + step - 1)
            return F.when((t < ts) | ((t == ts) & (s <= tie)), at + step).otherwise(at)

        return F.aggregate(F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))]), F.lit(0), go_on)

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the slice number: 0 for every key of ordinary size, else 1 and the number of cuts at or before the row.

        A join copies all it finds into every row, so a row gets the first cuts of its key's blocks, about the
        square root of their number, and then the cuts of its block alone.
        """
        side = max(1, math.isqrt(self.most_cuts))
        firsts = F.sequence(F.lit(0), F.greatest(F.size("_cut_t") - 1, F.lit(0)), F.lit(side))
        head = lambda c: F.transform(firsts, lambda i: F.get(c, i)).alias(f"_head{c}")
        blocks = self.table.select(*self.keys, "_cut_t", "_cut_s", F.explode(firsts).alias("_first"))
        cuts = [F.slice(c, F.col("_first") + 1, side).alias(c) for c in ("_cut_t", "_cut_s")]
        blocks = blocks.select(*self.keys, F.expr(f"int(_first div {side} + 1)").alias("_block"), *cuts)
        passed = self._passed("_head_cut_t", "_head_cut_s", -(-self.most_cuts // side))
        joined = join_small(df, self.table.select(*self.keys, head("_cut_t"), head("_cut_s")), self.keys)
        joined = joined.withColumn("_block", F.when(F.col("_head_cut_t").isNotNull(), passed)).drop("_head_cut_t", "_head_cut_s")
        joined = join_small(joined, blocks, (*self.keys, "_block"))
        # Before the first cut there is no block, and nothing to pass.
        number = 1 + F.greatest(F.col("_block") - 1, F.lit(0)) * side + self._passed("_cut_t", "_cut_s", side)
        return joined.withColumn(SLICE, F.when(F.col("_block").isNull(), 0).otherwise(number)).drop("_block", "_cut_t", "_cut_s")

    def only(self, tagged: DataFrame) -> DataFrame:
        """Rows of the keys that are cut up."""
        return tagged.filter(F.col(SLICE) > 0)


LOWEST = -(1 << 63)
# Cuts per row limit: with quantiles this much closer than `max_rows`, their error keeps a slice below the limit.
FINER = 1.5


def _quantiles(rows: DataFrame, keys: Sequence[str], value: str, pieces: dict[tuple, int]) -> dict[tuple, list[int]]:
    """For every listed key that many quantiles of `value`, by mergeable sketches: one pass per power of two of pieces."""
    classes: dict[int, list[tuple]] = {}
    for key, n in pieces.items():
        classes.setdefault(1 << (n - 1).bit_length(), []).append(key)
    out, fields = {}, [rows.schema[k] for k in keys]
    for n, members in classes.items():
        if n < 2:
            continue
        listed = small_table(rows.sparkSession, members, T.StructType(fields))
        fractions = [i / n for i in range(1, n)]
        sketch = F.percentile_approx(value, fractions, 16 * n).alias("_q")
        for r in join_small(rows, listed, keys, "inner").groupBy(*keys).agg(sketch).collect():
            out[tuple(r[k] for k in keys)] = r["_q"]
    return out


def find_hot(
    df: DataFrame, keys: Sequence[str], ts: str = "ts_ns", policy: SlicePolicy = DEFAULT_POLICY, tie: str | None = None
) -> HotKeys:
    """Find the keys with more than `policy.max_rows` rows and cut their rows by rank.

    Cuts are quantiles of the time, and where many rows have one time, of the whole number `tie` that
    breaks the tie; so a burst is cut like any other rows. The row limit is settled by one aggregate over the
    counts, before anything is collected: one row per large key, then their quantiles, both
    bounded by the policy.
    """
    keys = tuple(keys)
    if df.isStreaming:
        return HotKeys(keys, ts)
    tie = tie if tie and isinstance(df.schema[tie].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) else None
    rows = df.select(*dict.fromkeys((*keys, ts, *([tie] if tie else []))))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_lo")).filter(F.col("_n") > policy.max_rows)
    limits = [policy.max_rows << i for i in range(40)]
    slices = [F.sum(F.when(F.col("_n") > m, F.ceil(F.col("_n") / m))).alias(f"_s{i}") for i, m in enumerate(limits)]
    needed = counts.agg(*slices).first()
    if not needed[0]:
        return HotKeys(keys, ts)
    limit = next(m for i, m in enumerate(limits) if (needed[i] or 0) <= 2 * policy.max_slices)
    large = {tuple(r[k] for k in keys): (r["_n"], r["_lo"]) for r in counts.filter(F.col("_n") > limit).collect()}
    if not large:
        return HotKeys(keys, ts)

    # Sketches hold doubles, so they get the time since the key's first row. A cut may be anywhere, but a crowded time has to be exact.
    fields = [df.schema[k] for k in keys]
    lows = small_table(df.sparkSession, [(*k, lo) for k, (_, lo) in large.items()], T.StructType([*fields, T.StructField("_lo", T.LongType())]))
    since = join_small(rows, lows, keys, "inner").withColumn("_at", (F.col(ts) - F.col("_lo")).cast("double").cast("long"))
    found = _quantiles(since, keys, "_at", {k: math.ceil(FINER * n / limit) for k, (n, _) in large.items()})
    cuts = {k: {(large[k][1] + a, LOWEST) for a in q if a > 0} for k, q in found.items()}
    # A time that is a quantile twice holds about as many rows as a slice.
    crowded = [(*k, t) for k, q in found.items() for t in sorted({a for a, b in zip(q, q[1:]) if a == b})]
    if tie and tie != ts and crowded:
        listed = small_table(df.sparkSession, crowded, T.StructType([*fields, T.StructField("_at", T.LongType())]))
        same = join_small(since, listed, (*keys, "_at"), "inner")
        full = same.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_n"), F.min(tie).alias("_least")).filter(F.col("_n") > limit / FINER).collect()
        held = {tuple(r[c] for c in (*keys, ts)): r for r in full}
        for (*key, t), q in _quantiles(same, (*keys, ts), tie, {k: math.ceil(FINER * r["_n"] / limit) for k, r in held.items()}).items():
            least = held[*key, t]["_least"]
            cuts[tuple(key)] |= {(t, s) for s in q if least is not None and s > least}
            if t > large[tuple(key)][1]:
                cuts[tuple(key)].add((t, LOWEST))
    cuts = {k: sorted(c) for k, c in cuts.items() if c}
    if not cuts:
        return HotKeys(keys, ts)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*fields, T.StructField("_cut_t", longs), T.StructField("_cut_s", longs)])
    table = [(*k, [t for t, _ in c], [s for _, s in c]) for k, c in cuts.items()]
    n_slices, most = sum(len(c) + 1 for c in cuts.values()), max(len(c) for c in cuts.values())
    return HotKeys(keys, ts, tie, small_table(df.sparkSession, table, schema), n_slices, most)


class Ordered:
    """Rows of every key in time order, with the ordered columns one can ask for.

    Each method adds one column. `done()` gives the resulting DataFrame.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str] = ("ts_ns", "seq"),
        hot: HotKeys | None = None,
        policy: SlicePolicy = DEFAULT_POLICY,
    ):
        self.keys = tuple(keys)
        self.order = tuple(order)
        self.hot = find_hot(df, keys, order[0], policy, order[1] if len(order) > 1 else None) if hot is None else hot
        self.df = self.hot.tag(df) if self.hot else df
        self.part = (*self.keys, SLICE) if self.hot else self.keys

    def _window(self):
        return Window.partitionBy(*self.part).orderBy(*self.order)

    def _across(self):
        return Window.partitionBy(*self.keys).orderBy(SLICE)

    def _with_carry(self, summary: Column, carry) -> DataFrame:
        """Add `_carry`: what a slice of a large key takes over from its neighbours."""
        per_slice = self.hot.only(self.df).groupBy(*self.part).agg(summary.alias("_sum"))
        carried = per_slice.select(*self.part, carry(F.col("_sum"), self._across()).alias("_carry"))
        return join_small(self.df, carried, self.part)

    def _boxed(self, value: Column | str) -> Column:
        return F.struct((F.col(value) if isinstance(value, str) else value).alias("v"))

    def _edge(self, value: Column | str, extreme, extreme_by) -> Column:
        """Value at the first or last row of a slice; for the time itself a plain minimum or maximum."""
        if isinstance(value, str) and value == self.order[0]:
            return self._boxed(extreme(value))
        return extreme_by(self._boxed(value), F.struct(*self.order))

    def lag(self, into: str, value: Column | str) -> Ordered:
        """Value of the previous row of the key, null on its first row."""
        if not self.hot:
            self.df = self.df.withColumn(into, F.lag(value).over(self._window()))
            return self
        box = self._boxed(value)
        df = self._with_carry(self._edge(value, F.max, F.max_by), lambda s, w: F.lag(s).over(w))
        inside = F.lag(box).over(self._window())
        self.df = df.withColumn(into, F.coalesce(inside, F.col("_carry"))["v"]).drop("_carry")
        return self

    def lead(self, into: str, value: Column | str) -> Ordered:
        """Value of the next row of the key, null on its last row."""
        if not self.hot:
            self.df = self.df.withColumn(into, F.lead(value).over(self._window()))
            return self
        box = self._boxed(value)
        df = self._with_carry(self._edge(value, F.min, F.min_by), lambda s, w: F.lead(s).over(w))
        inside = F.lead(box).over(self._window())
        self.df = df.withColumn(into, F.coalesce(inside, F.col("_carry"))["v"]).drop("_carry")
        return self

    def position(self, into: str) -> Ordered:
        """0-based position of the row within its key."""
        if not self.hot:
            self.df = self.df.withColumn(into, F.row_number().over(self._window()).cast("long") - 1)
            return self
        df = self._with_carry(F.count(F.lit(1)), lambda s, w: F.sum(s).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        here = F.row_number().over(self._window()).cast("long") - 1
        self.df = df.withColumn(into, here + F.coalesce("_carry", F.lit(0))).drop("_carry")
        return self

    def running_sum(self, into: str, value: Column) -> Ordered:
        """Sum over the rows of the key up to and with this one."""
        w = self._window().rowsBetween(Window.unboundedPreceding, 0)
        if not self.hot:
            self.df = self.df.withColumn(into, F.sum(value).over(w))
            return self
        df = self._with_carry(F.sum(value), lambda s, a: F.sum(s).over(a.rowsBetween(Window.unboundedPreceding, -1)))
        self.df = df.withColumn(into, F.coalesce(F.sum(value).over(w), F.lit(0)) + F.coalesce("_carry", F.lit(0))).drop(
            "_carry"
        )
        return self

    def running_max(self, into: str, value: Column) -> Ordered:
        """Largest non-null value over the rows of the key up to and with this one."""
        w = self._window().rowsBetween(Window.unboundedPreceding, 0)
        if not self.hot:
            self.df = self.df.withColumn(into, F.max(value).over(w))
            return self
        df = self._with_carry(F.max(value), lambda s, a: F.max(s).over(a.rowsBetween(Window.unboundedPreceding, -1)))
        self.df = df.withColumn(into, F.greatest(F.max(value).over(w), F.col("_carry"))).drop("_carry")
        return self

    def next_match(self, into: str, value: Column) -> Ordered:
        """First non-null value at or after this row; `value` must be a struct or null.

        Walks backwards in time: a frame that ends at the current row is updated row by row,
        one that starts there would be evaluated anew for every row.
        """
        backwards = Window.partitionBy(*self.part).orderBy(*[F.col(c).desc() for c in self.order])
        inside = F.last(value, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, 0))
        if not self.hot:
            self.df = self.df.withColumn(into, inside)
            return self
        nearest = F.min_by(value, F.when(value.isNotNull(), F.struct(*self.order)))
        later = Window.partitionBy(*self.keys).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
        df = self._with_carry(nearest, lambda s, _: F.last(s, ignorenulls=True).over(later))
        self.df = df.withColumn(into, F.coalesce(inside, F.col("_carry"))).drop("_carry")
        return self

    def with_column(self, name: str, value: Column) -> Ordered:
        self.df = self.df.withColumn(name, value)
        return self

    def done(self) -> DataFrame:
        return self.df.drop(SLICE)


def number_rows(df: DataFrame, order: Sequence[str], into: str) -> DataFrame:
    """0-based place of every row in the order of the whole table, without a window over all of it.

    Rows are dealt into ranges, which are written down; the counts of the ranges, one row each, give
    where each begins, and rows are numbered within their range.
    """
    part = "_range"
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    before = F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    begins = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select(part, F.coalesce(before, F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("long") - 1
    return join_small(ranged.withColumn(into, here), begins, [part]).withColumn(into, F.col(into) + F.col("_before")).drop(part, "_before")
