"""Order-dependent folds over every key: state runs along the rows of a key in time order.

Rows are hash-partitioned by key and sorted, and a kernel walks through the Arrow batches, so
memory does not grow with the key. Keys too large for one task are cut into time slices (see
`slicing`).

Averages, partition rolls and throttles say for every state a slice can be entered with which
state it is left in (`Transfer`): the slices are summed up in parallel, and one short pass per key
goes from summary to summary. Averages are summed up as moments, so that a sliced average equals
one sequential pass but for rounding; all else is exactly equal.

Other kernels are folded in parallel from a guessed state, and slices whose guess differs from the
state their predecessor really ended in are folded again. Gates forget their past, so that a few
rounds settle most keys; after `REPAIRS` rounds the keys that are left take one pass along the key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from seriesmill.operators.joins import BROADCAST_ROWS
from seriesmill.operators.slicing import (
    DEFAULT_POLICY,
    SLICE,
    HotKeys,
    SlicePolicy,
    find_hot,
    join_small,
)
from seriesmill.session import cut_lineage

ENTRY, EXIT = "_entry", "_exit"


# Rounds in which slices whose guessed entry was wrong are folded again, all in parallel.
REPAIRS = 3


class Kernel:
    """One fold. `run` takes the state and a run of rows of one key, and gives the new state.

    `inputs` are the columns it reads, as numpy arrays; `outputs` the columns it adds. An output
    is a numpy array, a pair of array and null mask, or an Arrow array.
    """

    inputs: tuple[str, ...] = ()
    outputs: T.StructType
    state: T.StructType

    def fresh(self) -> tuple:
        raise NotImplementedError

    def run(self, state: tuple, cols: dict[str, np.ndarray]) -> tuple[tuple, dict[str, Any]]:
        raise NotImplementedError


class Transfer(Kernel):
    """A kernel that can sum up a slice as a map from entry state to exit state.

    After its first change of state within a slice, such a kernel depends only on the row at which
    that happened. Only the rows near the start of the slice can be that row, so the summary
    holds those rows and the state each of them leads to.
    """

    summary: T.StructType

    def paths(self) -> Paths:
        raise NotImplementedError

    def cross(self, state: tuple, summary: dict[str, np.ndarray]) -> tuple:
        """State after a slice entered with `state`."""
        raise NotImplementedError


class Paths:
    """Collects the summary of one slice from its batches."""

    def add(self, cols: dict[str, np.ndarray]) -> None:
        raise NotImplementedError

    def result(self) -> dict[str, Any]:
        raise NotImplementedError


def _spread(value: Any, kept: np.ndarray) -> Any:
    """An output of the kept rows as an output of all rows, null elsewhere."""
    data, mask = value if isinstance(value, tuple) else (value, np.zeros(len(value), dtype=bool))
    full, unset = np.zeros(len(kept), dtype=data.dtype), np.ones(len(kept), dtype=bool)
    full[kept], unset[kept] = data, mask
    return full, unset


class Chain(Kernel):
    """Several kernels in one pass over the same rows.

    With `keep`, a boolean output of the first kernel, the others see only the rows where it is
    true, and their outputs are null on the rest.
    """

    def __init__(self, *steps: Kernel, keep: str | None = None):
        self.steps, self.keep = steps, keep
        self.inputs = tuple(dict.fromkeys(c for k in steps for c in k.inputs))
        self.outputs = T.StructType([f for k in steps for f in k.outputs.fields])
        self.state = T.StructType(
            [T.StructField(f"{f.name}_{i}", f.dataType) for i, k in enumerate(steps) for f in k.state.fields]
        )

    def _parts(self, state: tuple) -> list[tuple]:
        parts, at = [], 0
        for k in self.steps:
            parts.append(state[at : at + len(k.state)])
            at += len(k.state)
        return parts

    def fresh(self):
        return tuple(v for k in self.steps for v in k.fresh())

    def run(self, state, cols):
        parts = self._parts(state)
        parts[0], out = self.steps[0].run(parts[0], cols)
        kept = out[self.keep] if self.keep else None
        if kept is not None:
            cols = {c: a[kept] for c, a in cols.items()}
        for i, kernel in enumerate(self.steps[1:], 1):
            if kept is None or kept.any():
                parts[i], more = kernel.run(parts[i], cols)
            else:
                more = {f.name: np.zeros(0, dtype=to_arrow_type(f.dataType).to_pandas_dtype()) for f in kernel.outputs}
            out |= {n: v if kept is None else _spread(v, kept) for n, v in more.items()}
        return tuple(v for p in parts for v in p), out


def _starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Row numbers at which a new key begins, the first row included."""
    n = batch.num_rows
    changed = np.zeros(n, dtype=bool)
    changed[0] = True
    for k in keys:
        col = batch.column(k)
        left, right = col.slice(1), col.slice(0, n - 1)
        differs = pc.fill_null(pc.not_equal(left, right), False)
        nulls = pc.xor(pc.is_null(left), pc.is_null(right))
        changed[1:] |= np.asarray(pc.or_(differs, nulls))
    return np.flatnonzero(changed)


def _key_at(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in keys)


def _entry_at(kernel: Kernel, batch: pa.RecordBatch, row: int) -> tuple:
    if ENTRY in batch.schema.names:
        given = batch.column(ENTRY)[row].as_py()
        if given is not None:
            return tuple(given[f] for f in kernel.state.names)
    return kernel.fresh()


def _numpy(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False)


def _segments(kernel: Kernel, keys: Sequence[str], batches: Iterator[pa.RecordBatch]):
    """Fold all batches; yields per batch its outputs and the (key, row, entry, state) of every run."""
    key, entry, state = None, None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = {c: _numpy(batch.column(c)) for c in kernel.inputs}
        starts = _starts(batch, keys)
        ends = np.append(starts[1:], batch.num_rows)
        runs, parts = [], []
        for s, e in zip(starts.tolist(), ends.tolist()):
            here = _key_at(batch, keys, s)
            if state is None or s > 0 or here != key:
                key, entry = here, _entry_at(kernel, batch, s)
                state = entry
            state, out = kernel.run(state, {c: a[s:e] for c, a in cols.items()})
            runs.append((key, entry, state))
            parts.append(out)
        yield batch, runs, parts


def _column(parts: list, name: str, arrow_type: pa.DataType) -> pa.Array:
    values = [p[name] for p in parts]
    if isinstance(values[0], pa.Array):
        return pa.concat_arrays(values).cast(arrow_type)
    pairs = [v if isinstance(v, tuple) else (v, np.zeros(len(v), dtype=bool)) for v in values]
    data = np.concatenate([v for v, _ in pairs])
    mask = np.concatenate([m for _, m in pairs])
    return pa.array(data, type=arrow_type, mask=mask)


def _full_pass(kernel: Kernel, keys: Sequence[str], schema: T.StructType):
    """Task function: the input rows with the kernel's outputs beside them, and the state after each run of rows if asked for."""
    leaves = EXIT in schema.names
    kept = [n for n in schema.names if n not in kernel.outputs.names and n != EXIT]
    out_types = {f.name: to_arrow_type(f.dataType) for f in kernel.outputs.fields}
    exit_type = to_arrow_type(kernel.state)

    def run(batches):
        for batch, runs, parts in _segments(kernel, keys, batches):
            columns = [batch.column(n) for n in kept]
            columns += [_column(parts, n, t) for n, t in out_types.items()]
            names = kept + list(out_types)
            if leaves:
                ends = np.append(_starts(batch, keys)[1:], batch.num_rows) - 1
                states = pa.array([dict(zip(kernel.state.names, state)) for _, _, state in runs], exit_type)
                at = np.zeros(batch.num_rows, dtype=np.int64)
                at[ends] = np.arange(len(ends))
                unset = np.ones(batch.num_rows, dtype=bool)
                unset[ends] = False
                columns.append(states.take(pa.array(at, mask=unset)))
                names.append(EXIT)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _exit_pass(kernel: Kernel, keys: Sequence[str], schema: T.StructType):
    """Task function: one row per key with the state it began and ended with."""
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def row(key, entry, state):
        named = lambda s: dict(zip(kernel.state.names, s))
        return {**dict(zip(keys, key)), ENTRY: named(entry), EXIT: named(state)}

    def run(batches):
        last = None
        for _, runs, _ in _segments(kernel, keys, batches):
            rows = []
            for r in runs:
                if last is not None and last[0] != r[0]:
                    rows.append(row(*last))
                last = r
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        if last is not None:
            yield pa.RecordBatch.from_pylist([row(*last)], schema=arrow)

    return run


def _arrange(df: DataFrame, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.repartition(*part).sortWithinPartitions(*part, *order)


def _summary_pass(kernel: Transfer, keys: Sequence[str], schema: T.StructType):
    """Task function: the summary of every slice, one row each."""
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def row(key, paths):
        return pa.RecordBatch.from_pylist([{**dict(zip(keys, key)), **paths.result()}], schema=arrow)

    def run(batches):
        key, paths = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = {c: _numpy(batch.column(c)) for c in kernel.inputs}
            starts = _starts(batch, keys).tolist()
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                here = _key_at(batch, keys, s)
                if paths is not None and here != key:
                    yield row(key, paths)
                    paths = None
                if paths is None:
                    key, paths = here, kernel.paths()
                paths.add({c: a[s:e] for c, a in cols.items()})
        if paths is not None:
            yield row(key, paths)

    return run


def _cross_pass(kernel: Transfer, keys: Sequence[str], schema: T.StructType):
    """Task function: the entry state of every slice, going from summary to summary of a key."""
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches):
        key, state = None, None
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                here = _key_at(batch, keys, i)
                if state is None or here != key:
                    key, state = here, _entry_at(kernel, batch, i)
                entry = dict(zip(kernel.state.names, state))
                rows.append({**dict(zip(keys, key)), SLICE: batch.column(SLICE)[i].as_py(), ENTRY: entry})
                parts = {}
                for f in kernel.summary.names:
                    value = batch.column(f)[i]
                    parts[f] = value.values.to_numpy() if isinstance(value, pa.ListScalar) else value.as_py()
                state = kernel.cross(state, parts)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return run


def _cross(rows: DataFrame, kernel: Transfer, hot: HotKeys, order: Sequence[str], given: DataFrame | None) -> DataFrame:
    """The entry states of a kernel with summaries: two passes, whatever the number of slices."""
    part = (*hot.keys, SLICE)
    placed = [rows.schema[k] for k in part]
    summed = T.StructType([*placed, *kernel.summary.fields])
    summaries = _arrange(rows, part, order).mapInArrow(_summary_pass(kernel, part, summed), summed)
    entered = T.StructType([*placed, T.StructField(ENTRY, kernel.state)])
    if given is not None:
        summaries = join_small(summaries, given, hot.keys)
    along = summaries.repartition(*hot.keys).sortWithinPartitions(*part)
    return cut_lineage(along.mapInArrow(_cross_pass(kernel, hot.keys, entered), entered))


def _walk(rows: DataFrame, kernel: Kernel, hot: HotKeys, order: Sequence[str]) -> DataFrame:
    """The entry states by one pass along each key, in one task per key and batches of bounded memory."""
    part = (*hot.keys, SLICE)
    schema = T.StructType([*[rows.schema[k] for k in part], T.StructField(ENTRY, kernel.state)])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches):
        key, here, state = None, None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = {c: _numpy(batch.column(c)) for c in kernel.inputs}
            starts, entered = _starts(batch, part).tolist(), []
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                at = _key_at(batch, part, s)
                if state is None or at[:-1] != key:
                    key, state = at[:-1], _entry_at(kernel, batch, s)
                if at != here:
                    here = at
                    entered.append({**dict(zip(part, at)), ENTRY: dict(zip(kernel.state.names, state))})
                state, _ = kernel.run(state, {c: a[s:e] for c, a in cols.items()})
            if entered:
                yield pa.RecordBatch.from_pylist(entered, schema=arrow)

    return rows.repartition(*hot.keys).sortWithinPartitions(*part, *order).mapInArrow(run, schema)


def _repair(rows: DataFrame, kernel: Kernel, hot: HotKeys, order: Sequence[str], given: DataFrame | None) -> DataFrame:
    """The entry states of any kernel, by repairing guesses.

    Kernels that forget their past settle in a round or two. What is still stale after `REPAIRS`
    rounds is folded along its key, so the number of jobs does not grow with the slices.
    """
    part = (*hot.keys, SLICE)
    schema = T.StructType(
        [rows.schema[k] for k in part] + [T.StructField(ENTRY, kernel.state), T.StructField(EXIT, kernel.state)]
    )
    exit_pass = _exit_pass(kernel, part, schema)
    if given is not None:
        rows = join_small(rows, given.withColumn(SLICE, F.lit(1)), part)
    # shuffled and sorted once; a broadcast join leaves rows where and in which order they are
    arranged = cut_lineage(_arrange(rows, part, order))
    states = cut_lineage(arranged.mapInArrow(exit_pass, schema))
    before = Window.partitionBy(*hot.keys).orderBy(SLICE)
    for left in reversed(range(REPAIRS + 1)):
        wanted = states.withColumn("_want", F.lag(EXIT).over(before))
        stale = wanted.filter(F.col("_want").isNotNull() & ~F.col("_want").eqNullSafe(F.col(ENTRY)))
        stale = stale.select(*part, F.col("_want").alias(ENTRY))
        if stale.isEmpty():
            break
        if not left:
            unsettled = stale.select(*hot.keys).distinct()
            walked = _walk(join_small(rows, unsettled, hot.keys, "inner"), kernel, hot, order)
            done = join_small(states, unsettled.withColumn("_redo", F.lit(True)), hot.keys).filter("_redo is null")
            return cut_lineage(done.select(*part, ENTRY).unionByName(walked.select(*part, ENTRY)))
        redone = join_small(arranged.drop(ENTRY), stale, part, "inner").mapInArrow(exit_pass, schema)
        settled = join_small(states, stale.select(*part, F.lit(True).alias("_redo")), part).filter("_redo is null")
        states = cut_lineage(settled.drop("_redo").unionByName(redone))
    return states.select(*part, ENTRY)


def _settle(tagged: DataFrame, kernel: Kernel, hot: HotKeys, order: Sequence[str], given: DataFrame | None = None) -> DataFrame:
    """The true entry state of every slice of the large keys; `given` has the state of a key before its first row, if it has one."""
    part = (*hot.keys, SLICE)
    if isinstance(kernel, Chain):
        return _settle_chain(tagged, kernel, hot, order, given)
    rows = hot.only(tagged).select(*dict.fromkeys((*part, *order, *kernel.inputs)))
    settle = _cross if isinstance(kernel, Transfer) else _repair
    return settle(rows, kernel, hot, order, given)


def _settle_chain(tagged: DataFrame, kernel: Chain, hot: HotKeys, order: Sequence[str], given: DataFrame | None) -> DataFrame:
    """Settle the kernels of a chain one by one; behind a gate, on the rows it really admits."""
    part = (*hot.keys, SLICE)
    own = lambda i: F.struct(*[F.col(ENTRY)[f"{n}_{i}"].alias(n) for n in kernel.steps[i].state.names])
    before = [given if given is None else given.select(*hot.keys, own(i).alias(ENTRY)) for i in range(len(kernel.steps))]
    every = _settle(tagged, kernel.steps[0], hot, order, before[0]).withColumnRenamed(ENTRY, "_entry_0")
    rows = tagged
    if kernel.keep:
        gate = kernel.steps[0]
        schema = T.StructType([*tagged.schema.fields, *gate.outputs.fields])
        entered = join_small(hot.only(tagged), every.withColumnRenamed("_entry_0", ENTRY), part)
        rows = _pass_on(_arrange(entered, part, order), gate, part, schema).filter(kernel.keep)
    for i, step in enumerate(kernel.steps[1:], 1):
        one = _settle(rows, step, hot, order, before[i]).withColumnRenamed(ENTRY, f"_entry_{i}")
        every = join_small(every, one, part)
    fields = [F.col(f"_entry_{i}")[f.name].alias(f"{f.name}_{i}") for i, k in enumerate(kernel.steps) for f in k.state]
    return every.select(*part, F.struct(*fields).alias(ENTRY))


def _pass_on(rows: DataFrame, kernel: Kernel, part: Sequence[str], schema: T.StructType) -> DataFrame:
    """All rows through the kernel, their null arrays as empty ones beside a flag.

    Spark writes rows to Arrow with a look at the size of the batch after each, which for every array column goes
    over the nulls since its last array: a column without arrays costs the square of the rows of a batch.
    """
    flags = {f.name: f"_null_{f.name}" for f in rows.schema if isinstance(f.dataType, T.ArrayType) and f.nullable}
    filled = {c: F.coalesce(c, F.array().cast(rows.schema[c].dataType)) for c in flags}
    rows = rows.withColumns({**{flag: F.col(c).isNull() for c, flag in flags.items()}, **filled})
    first = [T.StructField(flag, T.BooleanType()) for flag in flags.values()]
    flagged = T.StructType([*first, *schema.fields])
    folded = rows.mapInArrow(_full_pass(kernel, part, flagged), flagged)
    return folded.select(*[F.when(~F.col(flags[c]), F.col(c)).alias(c) if c in flags else c for c in schema.names])


def _entered(rows: DataFrame, entry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the state their key, or slice of a key, is entered with; null-safe, broadcast only behind a count."""
    if entry.count() <= BROADCAST_ROWS:
        return join_small(rows, entry, keys)
    named = entry.select(*[F.col(k).alias(f"_k_{k}") for k in keys], ENTRY)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(named, same, "left").drop(*[f"_k_{k}" for k in keys])


def fold(
    df: DataFrame,
    keys: Sequence[str],
    kernel: Kernel,
    order: Sequence[str] = ("ts_ns", "seq"),
    hot: HotKeys | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
    entry: DataFrame | None = None,
    exits: bool = False,
) -> DataFrame:
    """Run `kernel` over the rows of every key in time order; gives `df` with its outputs added.

    A fold can go on where another ended: `entry` has the keys and their state so far (`_entry`); a
    key without one starts afresh. With `exits` the rows carry what `exit_states` needs.
    """
    keys = tuple(keys)
    hot = find_hot(df, keys, order[0], policy, order[1] if len(order) > 1 else None) if hot is None else hot
    left = [T.StructField(EXIT, kernel.state)] if exits else []
    schema = T.StructType([*df.schema.fields, *kernel.outputs.fields, *left])
    if not hot:
        rows = df if entry is None else _entered(df, entry, keys)
        return _pass_on(_arrange(rows, keys, order), kernel, keys, schema)
    tagged = hot.tag(df)
    part = (*keys, SLICE)
    if entry is None:
        rows = join_small(tagged, _settle(tagged, kernel, hot, order), part)
    else:
        # the states of the large keys, as few as these, go to the settling; the others to their rows
        large = hot.table.select(*keys)
        given = join_small(entry.select(*keys, ENTRY), large, keys, "inner")
        settled = _settle(tagged, kernel, hot, order, given)
        others = join_small(entry.select(*keys, ENTRY), large.withColumn("_large", F.lit(True)), keys).filter("_large is null")
        rows = _entered(tagged, settled.unionByName(others.select(*keys, F.lit(0).alias(SLICE), ENTRY)), part)
    return _pass_on(_arrange(rows, part, order), kernel, part, schema)


def exit_states(folded: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts_ns", "seq")) -> DataFrame:
    """The state in which a fold with `exits` left every key, to enter the next one with: keys and `_entry`.

    Only the last row of every run of rows has a state, so there is about one row per key and Arrow batch.
    """
    left = folded.filter(F.col(EXIT).isNotNull())
    return left.groupBy(*keys).agg(F.max_by(EXIT, F.struct(*order)).alias(ENTRY))
