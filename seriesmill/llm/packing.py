"""Token sequences of fixed length, packed online by the sum-of-squares rule.

Every task packs the documents of its partition as they come. Full sequences are cut off the front
of a long document; what remains goes to the open sequence whose level (tokens so far) leaves the
least sum of squared counts of open sequences by level, tracked in one array over all levels.
When the partition ends, the fullest open sequences stay and are filled up with ids of the emptiest
ones, and the last one is cut into powers of two, so no sequence needs padding.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import small_batches
from seriesmill.llm.segments import encoder, slices

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
# Sequence ids are the partition's number and a count within it.
PER_PARTITION = 1 << 33


class SumOfSquares:
    """Open sequences by level. `place` says which level takes a piece of the given size."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list] = {}
        self.moved = 0

    def best_level(self, size: int) -> int:
        """0 for a new sequence. The change of the sum of squares decides, then the higher level."""
        n, top = self.levels, self.capacity - size
        best, change = 0, 2 * n[size] + 1
        if top > 0:
            below = n[1 : top + 1]
            changes = 2 * (n[size + 1 : self.capacity + 1] - below) + 2
            changes[-1] -= 1  # a full sequence is no longer counted
            changes[below == 0] = np.iinfo(np.int64).max
            at = top - 1 - int(np.argmin(changes[::-1]))
            if changes[at] <= change:
                best = at + 1
        return best

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece in; the sequence's pieces if it is full now."""
        level = self.best_level(size)
        pieces = []
        if level:
            self.levels[level] -= 1
            pieces = self.open[level].pop()
        pieces.append(piece)
        if level + size == self.capacity:
            return pieces
        self.levels[level + size] += 1
        self.open.setdefault(level + size, []).append(pieces)
        return None

    def drain(self) -> Iterator[list]:
        """The open sequences: the fullest stay as they are and are filled up with ids of the emptiest, the last one is cut into powers of two.

        `moved` counts the ids that leave the sequence they were placed in, those of the emptiest sequences alone.
        """
        left = deque(pieces for level in sorted(self.open) for pieces in self.open[level])
        donor: list = []
        while left:
            filled = list(left.pop())
            room = self.capacity - sum(len(p[2]) for p in filled)
            while room and (donor or left):
                if not donor:
                    donor = list(left.popleft())
                doc, start, ids, total = donor.pop()
                take = min(room, len(ids))
                filled.append((doc, start, ids[:take], total))
                if take < len(ids):
                    donor.append((doc, start + take, ids[take:], total))
                room, self.moved = room - take, self.moved + take
            yield from [filled] if not room else self.cut(filled)
        yield from self.cut(donor)

    def cut(self, pieces: list) -> Iterator[list]:
        """One sequence as sequences of powers of two, the largest first."""
        size = sum(len(p[2]) for p in pieces)
        while size:
            part = 1 << (size.bit_length() - 1)
            whole, room, rest = [], part, []
            for doc, start, ids, total in pieces:
                take = min(room, len(ids))
                if take:
                    whole.append((doc, start, ids[:take], total))
                if take < len(ids):
                    rest.append((doc, start + take, ids[take:], total))
                room -= take
            yield whole
            pieces, size = rest, size - part


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    `with_ids` the piece's ids.

    Each id of a document, its end id included, lies in exactly one piece. A null or empty text is
    the end id alone. Sequences hold `capacity` ids, but for at most one per power of two and
    partition; none needs padding. Repeated rows are packed each for itself, so their pieces look
    alike but for the place; null keys stay null. An empty table gives no pieces. Other columns
    are not read. A task that runs again over the same rows gives the same pieces.
    """
    small_batches(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"_key {key_type}, {PIECES}" + (", ids array<int>" if with_ids else "")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, base = encoder(tokenizer), TaskContext.get().partitionId() * PER_PARTITION
        packer, done, count = SumOfSquares(capacity), [], 0

        def rows(sequences: list[list]) -> pa.RecordBatch:
            nonlocal count
            out = [[] for _ in range(7)]
            ids_out = []
            for pieces in sequences:
                offset = 0
                for doc, start, ids, total in pieces:
                    wide = ids.astype("<u4")
                    for column, value in zip(out, (doc, start, len(ids), zlib.crc32(wide.tobytes()), total, base + count, offset)):
                        column.append(value)
                    if with_ids:
                        ids_out.append(wide.astype(np.int32))
                    offset += len(ids)
                count += 1
            names = ["_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(out[0], key_arrow), *[pa.array(c, pa.int64()) for c in out[1:]]]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        key_arrow = pa.int64()
        for whole in batches:
            key_arrow = whole.schema.field(0).type
            for batch in slices(whole):
                keys = batch.column(0).to_pylist()
                ids, begins = coder.encode(batch.column(1))
                for doc, a, b in zip(keys, begins[:-1].tolist(), begins[1:].tolist()):
                    own = np.append(ids[a:b], ids.dtype.type(end_id))
                    total = len(own)
                    full = total - total % capacity
                    done.extend([(doc, at, own[at : at + capacity], total)] for at in range(0, full, capacity))
                    if full < total:
                        closed = packer.place((doc, full, own[full:], total), total - full)
                        if closed:
                            done.append(closed)
                yield rows(done)
                done = []
        yield rows(list(packer.drain()))

    out = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(pack, schema)
    return out.withColumnRenamed("_key", key)
