"""Reading numbers out of binary columns.

Header integers use built-in expressions. Value payloads are reinterpreted in Arrow buffers:
one array operation per type and byte order of a batch, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.times import as_col
from seriesmill.schemas import DOUBLE, LONG, struct

# Element layout of every numeric scalar type, without byte order.
LAYOUT = {
    "I8": "i1", "I16": "i2", "I32": "i4", "I64": "i8",
    "U8": "u1", "U16": "u2", "U32": "u4", "U64": "u8",
    "F32": "f4", "F64": "f8", "ENUM": "i2", "BOOL": "u1",
}

DECODED = struct(ints=T.ArrayType(LONG), wide=T.ArrayType(T.DecimalType(20, 0)), floats=T.ArrayType(DOUBLE))


def unsigned(payload: Column | str, offset: int, size: int) -> Column:
    """Big-endian unsigned integer of `size` bytes at a 0-based offset; for up to 7 bytes."""
    return F.conv(F.hex(F.substring(as_col(payload), offset + 1, size)), 16, 10).cast("long")


def item_size(kind: Column | str) -> Column:
    """Bytes per element of a scalar type, null for strings."""
    kind = as_col(kind)
    return F.coalesce(*[F.when(kind == k, F.lit(int(layout[1]))) for k, layout in LAYOUT.items()])


def _scatter(parts: list, rows: list, n: int, kind: pa.DataType) -> pa.Array:
    """One list array of `n` rows from the lists of some rows; the others are null."""
    if not parts:
        return pa.nulls(n, pa.list_(kind))
    where = np.full(n, -1, dtype=np.int64)
    where[np.concatenate(rows)] = np.arange(sum(len(r) for r in rows))
    return pa.concat_arrays(parts).take(pa.array(where, mask=where < 0))


def decode_payloads(payload: pa.Array, kind: pa.Array, big: pa.Array) -> pa.Array:
    n = len(payload)
    payload = payload.cast(pa.large_binary())
    kinds = np.array(kind.to_pylist(), dtype=object)
    bigs = np.array(big.fill_null(False).to_pylist(), dtype=bool)
    present = np.asarray(payload.is_valid())
    sizes = np.asarray(pc.fill_null(pc.binary_length(payload), 0))
    found = {"ints": ([], []), "wide": ([], []), "floats": ([], [])}
    types = {"ints": pa.int64(), "wide": pa.decimal128(20, 0), "floats": pa.float64()}
    for k in {x for x in kinds if x in LAYOUT}:
        layout = LAYOUT[k]
        whole = present & (sizes % int(layout[1]) == 0)
        for order in (False, True):
            rows = np.flatnonzero((kinds == k) & (bigs == order) & whole)
            if len(rows) == 0:
                continue
            chosen = payload.take(pa.array(rows))
            offsets = np.frombuffer(chosen.buffers()[1], dtype=np.int64, count=len(rows) + 1)
            raw = chosen.buffers()[2]
            raw = memoryview(raw)[offsets[0] : offsets[-1]] if raw is not None else b""
            values = np.frombuffer(raw, dtype=(">" if order else "<") + layout)
            if k == "BOOL":
                values = values != 0
            if layout[0] == "f":
                target, items = "floats", pa.array(values.astype(np.float64))
            elif k == "U64":
                target, items = "wide", pa.array(values.astype(np.uint64)).cast(types["wide"])
            else:
                target, items = "ints", pa.array(values.astype(np.int64))
            ends = pa.array(((offsets - offsets[0]) // int(layout[1])).astype(np.int32))
            found[target][0].append(pa.ListArray.from_arrays(ends, items))
            found[target][1].append(rows)
    columns = [_scatter(*found[f], n, types[f]) for f in found]
    return pa.StructArray.from_arrays(columns, names=list(found))


@F.arrow_udf(DECODED)
def decode_values(payload: pa.Array, kind: pa.Array, big: pa.Array) -> pa.Array:
    """Elements of a payload by type and byte order; null where its length does not fit the type."""
    return decode_payloads(payload, kind, big)


def strip_terminator(payload: Column | str) -> Column:
    """Bytes up to the first NUL as text; invalid UTF-8 becomes the replacement character."""
    head = F.regexp_extract(F.hex(as_col(payload)), "^((?:(?!00)..)*)", 1)
    return F.make_valid_utf8(F.unhex(head).cast("string"))


def fixed_strings(payload: Column | str, width: int = 40) -> Column:
    """Texts of a payload made of fixed-width, NUL-terminated fields."""
    fields = F.floor(F.octet_length(as_col(payload)) / width).cast("int")
    cut = lambda i: strip_terminator(F.substring(as_col(payload), i * width + 1, F.lit(width)))
    return F.when(fields > 0, F.transform(F.sequence(F.lit(0), fields - 1), cut)).otherwise(F.array().cast("array<string>"))
