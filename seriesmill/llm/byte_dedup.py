"""Byte strings that stand in an earlier document already, found with suffix arrays.

Texts are dealt into blocks. A window is `size` consecutive bytes of one text.

1. The anchor of a window is the smallest hash among its runs of `seed` bytes; consecutive windows
   with one anchor are a stretch. Every block sends its sorted distinct anchors, cut by binary search
   into ranges of the hash space; a range answers which of them other texts have too.
   Windows that are equal have equal anchors, so all else (most of a corpus) goes no further.
2. Stretches with a shared anchor travel as byte strings, equal ones of a block once, to the shard
   of their anchor. A shard builds the suffix array of its strings (Larsson and Sadakane), their
   common prefixes (Kasai), and has the smallest key of every group of equal windows.
3. Strings of an anchor with more than `hot` stretches are dealt over all shards by their own hash. Each
   shard sorts its windows as before; the sorted runs are then merged by binary search.
4. Answers (which windows of which string stand in an earlier text) go back to the block, whose texts
   lose the bytes covered.

Texts cross the network once, to their block, and that shuffle serves all three visits. Nothing is
broadcast or collected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.shingles import mix
from seriesmill.llm.substring_dedup import running_min
from seriesmill.llm.suffix_arrays import least_by_prefix, merged_least, words_of

# Stretches of one anchor beyond which its strings are dealt over all shards.
HOT = 20_000
# Bytes of one suffix array, unless a single anchor has more.
SHARD_BYTES = 1_500_000
# Positions hashed at a time, for the sake of the processor's cache.
CHUNK = 1 << 17
# Windows of a stretch; their marks fit into 64 bits.
LONGEST = 60
NO_KEY = np.iinfo(np.int64).max

ANCHORS = "rank int, block int, hashes binary, counts binary"
FLAGS = "block int, rank int, flags binary"
STRINGS = "shard int, block int, hot boolean, names binary, sizes binary, anchors binary, least binary, body binary"
RUNS = "part int, keys binary, least binary, times binary, block binary, name binary, at binary, own binary"
FOUND = "block int, names binary, marks binary"


def column(batch: pa.Table, name: str) -> list:
    return batch.column(name).to_pylist()


class Block:
    """The texts of a block in an order of its own, and the stretches of windows with one anchor."""

    def __init__(self, rows: pa.Table, size: int, seed: int):
        keys, texts = column(rows, "doc"), rows.column("body").to_pylist()
        at = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0, texts[i]))
        self.keys, texts = [keys[i] for i in at], [texts[i] for i in at]
        self.key = np.array([NO_KEY if k is None else k for k in self.keys], np.int64)
        self.ends = np.cumsum([0, *map(len, texts)])
        self.body = np.frombuffer(b"".join(texts), np.uint8)
        self.size, self.seed = size, seed
        self._stretches()

    def _stretches(self) -> None:
        n, size, seed = len(self.body), self.size, self.seed
        starts, anchors, counts = [], [], []
        # No window begins in the last bytes of a text, nor anywhere in one without a key.
        end = np.append(self.ends[1:], 0)[: len(self.keys)]
        for a in range(0, max(n - size + 1, 0), CHUNK):
            part = self.body[a : min(a + CHUNK + size - 1, n)]
            hashes = seed_hashes(part, seed)
            lowest = running_min(hashes, size - seed + 1)
            m = len(lowest)
            first, last = np.searchsorted(self.ends, [a, a + m], "right") - 1
            valid = np.ones(m, bool)
            for d in range(int(first), min(int(last), len(self.keys) - 1) + 1):
                stop = end[d] - a
                valid[max(0, stop - size + 1) : max(0, stop)] = False
                if self.keys[d] is None:
                    valid[max(0, self.ends[d] - a) : max(0, stop)] = False
            new = np.ones(m, bool)
            new[1:] = (lowest[1:] != lowest[:-1]) | ~valid[:-1]
            begin = np.flatnonzero(new & valid)
            if not len(begin):
                continue
            breaks = np.flatnonzero(new | ~valid)
            stop = np.append(breaks, m)[np.searchsorted(breaks, begin, "right")]
            count = stop - begin
            pieces = -(-count // LONGEST)  # an anchor that comes again and again: a long stretch is cut
            if (pieces > 1).any():
                own = np.repeat(np.arange(len(begin)), pieces)
                k = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin, count = begin[own] + k * LONGEST, np.minimum(count[own] - k * LONGEST, LONGEST)
            starts.append(begin + a)
            anchors.append(lowest[begin])
            counts.append(count)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.starts, self.anchors, self.counts = join(starts, np.int64), join(anchors, np.uint64), join(counts, np.int64)
        self.docs = np.searchsorted(self.ends, self.starts, "right") - 1
        self.distinct, self.of, self.times = np.unique(self.anchors, return_inverse=True, return_counts=True)

    def strings(self, which: np.ndarray) -> list[bytes]:
        data = self.body.tobytes()
        a, b = self.starts[which], self.starts[which] + self.counts[which] + self.size - 1
        return [data[i:j] for i, j in zip(a.tolist(), b.tolist())]

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """For every stretch the first one of the block with the same bytes; of those the smallest key."""
        name = np.arange(len(self.starts))
        again = np.flatnonzero(self.times[self.of] > 1)
        seen: dict[bytes, int] = {}
        name[again] = [seen.setdefault(s, i) for i, s in zip(again.tolist(), self.strings(again))]
        least = self.key[self.docs]
        np.minimum.at(least, name[again], self.key[self.docs[again]])
        return name, least[name]

    def shared_inside(self) -> np.ndarray:
        """Of every distinct anchor, whether two texts of the block have it."""
        order = np.argsort(self.of, kind="stable")
        first = np.cumsum(self.times) - self.times
        docs = self.docs[order]
        return np.minimum.reduceat(docs, first) < np.maximum.reduceat(docs, first) if len(first) else np.zeros(0, bool)


def seed_hashes(body: np.ndarray, seed: int) -> np.ndarray:
    """A hash of every run of `seed` bytes: eight bytes at a time, the last eight overlapping."""
    n = max(len(body) - seed + 1, 0)
    words = words_of(body)
    if seed < 8:
        return mix(words[:n] >> np.uint64(8 * (8 - seed)))
    out = words[:n]
    for at in [*range(8, seed - 8, 8), seed - 8] if seed > 8 else []:
        out = mix(out) + words[at : at + n]
    return mix(out)


def sent_anchors(block: Block, number: int, ranges: int) -> Iterator[tuple]:
    """One row per range: the low five bytes of its anchors, and how often each stands in the block (the top bit: in two texts)."""
    edges = np.searchsorted(block.distinct, range_begins(ranges)).tolist() + [len(block.distinct)]
    counts = np.minimum(block.times, 0x7FFF).astype(np.uint16) | (block.shared_inside().astype(np.uint16) << np.uint16(15))
    low = block.distinct.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    for r, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            yield r, number, low[a:b].tobytes(), counts[a:b].tobytes()


def range_begins(ranges: int) -> np.ndarray:
    return np.array([(r << 64) // ranges for r in range(ranges)], np.uint64)


def judged_anchors(rows: pa.Table, hot: int) -> Iterator[tuple]:
    """For every block's anchors of a range: 0 alone, 1 shared, 2 shared and hot."""
    hashes = [np.frombuffer(h, np.uint8).reshape(-1, 5) for h in column(rows, "hashes")]
    sizes = np.array([len(h) for h in hashes])
    wide = np.zeros((sizes.sum(), 8), np.uint8)
    wide[:, :5] = np.concatenate(hashes)
    counts = np.frombuffer(b"".join(column(rows, "counts")), np.uint16)
    _, of, blocks = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
    total = np.bincount(of, counts & 0x7FFF)
    inside = np.zeros(len(blocks), bool)
    inside[of[counts >> 15 > 0]] = True
    flag = np.where((blocks > 1) | inside, np.where(total > hot, 2, 1), 0).astype(np.uint8)[of]
    ends = np.cumsum(sizes)
    for number, rank, a, b in zip(column(rows, "block"), column(rows, "rank"), ends - sizes, ends):
        yield number, rank, flag[a:b].tobytes()


def sent_strings(block: Block, number: int, flags: pa.Table, shards: int) -> Iterator[tuple]:
    """The block's distinct strings with a shared anchor, packed by shard."""
    if not len(block.starts):
        return
    ranks = column(flags, "rank")
    parts = column(flags, "flags")
    flag = np.frombuffer(b"".join(parts[i] for i in np.argsort(ranks)), np.uint8)[block.of]
    name, least = block.names()
    chosen = np.flatnonzero((flag > 0) & (name == np.arange(len(name))))
    if not len(chosen):
        return
    strings, is_hot = block.strings(chosen), flag[chosen] == 2
    shard = (mix(block.anchors[chosen]) % np.uint64(shards)).astype(np.int64)
    for i in np.flatnonzero(is_hot).tolist():
        shard[i] = zlib.crc32(strings[i]) % shards
    order = np.lexsort((is_hot, shard))
    group = shard[order] * 2 + is_hot[order]
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    for a, b in zip(begins, np.append(begins[1:], len(order))):
        own = order[a:b]
        at = chosen[own]
        yield (
            int(shard[own[0]]), number, bool(is_hot[own[0]]), at.astype("<u4").tobytes(), block.counts[at].astype(np.uint8).tobytes(),
            block.anchors[at].astype("<u8").tobytes(), least[at].astype("<i8").tobytes(), b"".join(strings[i] for i in own.tolist()),
        )


class Strings:
    """Strings of several blocks, equal ones once, with all their (block, name, smallest key)."""

    def __init__(self, rows: pa.Table, size: int):
        self.block = np.repeat(np.array(column(rows, "block"), np.int64), [len(x) // 4 for x in column(rows, "names")])
        unpack = lambda name, kind: np.frombuffer(b"".join(column(rows, name)), kind)
        self.name, self.least = unpack("names", "<u4").astype(np.int64), unpack("least", "<i8")
        counts, anchors = unpack("sizes", np.uint8).astype(np.int64), unpack("anchors", "<u8")
        body = b"".join(column(rows, "body"))
        ends = np.cumsum(counts + size - 1)
        seen: dict[bytes, int] = {}
        self.of = np.array([seen.setdefault(body[a:b], len(seen)) for a, b in zip((ends - counts - size + 1).tolist(), ends.tolist())], np.int64)
        self.strings = list(seen)
        self.counts = np.zeros(len(seen), np.int64)
        self.counts[self.of] = counts
        self.anchors = np.zeros(len(seen), np.uint64)
        self.anchors[self.of] = anchors
        self.lowest = np.full(len(seen), NO_KEY)
        np.minimum.at(self.lowest, self.of, self.least)

    def windows(self, which: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chosen strings in a row: the bytes, where each window begins, and which string it is of."""
        body = np.frombuffer(b"".join(self.strings[i] for i in which.tolist()), np.uint8)
        counts = self.counts[which]
        of = np.repeat(np.arange(len(which)), counts)
        first = np.cumsum(counts + size - 1) - counts - size + 1
        return body, first[of] + np.arange(len(of)) - (np.cumsum(counts) - counts)[of], of


def marks_by_block(block: np.ndarray, name: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
    """Rows of (block, names, marks): a bit for every window `at` of a string."""
    if not len(block):
        return
    order = np.lexsort((name, block))
    block, name, bits = block[order], name[order], np.uint64(1) << at[order].astype(np.uint64)
    new = np.concatenate([[True], (block[1:] != block[:-1]) | (name[1:] != name[:-1])])
    begins = np.flatnonzero(new)
    block, name, marks = block[begins], name[begins], np.bitwise_or.reduceat(bits, begins)
    edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    for a, b in zip(edges, np.append(edges[1:], len(block))):
        yield int(block[a]), name[a:b].astype("<u4").tobytes(), marks[a:b].astype("<u8").tobytes()


def found_in_shard(rows: pa.Table, size: int) -> Iterator[tuple]:
    """Windows of plain strings whose smallest key is below that of the string."""
    rows = rows.filter(pc.invert(rows.column("hot")))
    if not len(rows):
        return
    held = Strings(rows, size)
    total = int((held.counts + size - 1).sum())
    parts = -(-total // SHARD_BYTES)
    part = (mix(held.anchors + np.uint64(1)) >> np.uint64(20)) % np.uint64(parts)
    least, first = np.full(int(held.counts.sum()), NO_KEY), np.cumsum(held.counts) - held.counts
    for p in range(parts):
        which = np.flatnonzero(part == np.uint64(p))
        body, starts, of = held.windows(which, size)
        groups, lowest, _ = least_by_prefix(body, starts, held.lowest[which][of], size)
        if len(groups):
            k = np.arange(len(of)) - (np.cumsum(held.counts[which]) - held.counts[which])[of]
            least[first[which][of] + k] = lowest[groups]
    # Every (block, name) beside each window of its string.
    counts = held.counts[held.of]
    member = np.repeat(np.arange(len(held.of)), counts)
    at = np.arange(len(member)) - (np.cumsum(counts) - counts)[member]
    earlier = least[first[held.of][member] + at] < held.least[member]
    member, at = member[earlier], at[earlier]
    yield from marks_by_block(held.block[member], held.name[member], at)


def sorted_runs(rows: pa.Table, size: int, parts: int) -> Iterator[tuple]:
    """The distinct windows of a shard's hot strings in order, each with its smallest key and all its places, dealt by hash."""
    rows = rows.filter(rows.column("hot"))
    if not len(rows):
        return
    held = Strings(rows, size)
    member_order = np.argsort(held.of, kind="stable")
    per = np.bincount(held.of, minlength=len(held.strings))
    first_member = np.cumsum(per) - per
    ends = np.cumsum(held.counts + size - 1)
    shard = (ends - 1) // SHARD_BYTES
    runs = []
    for p in np.unique(shard):
        which = np.flatnonzero(shard == p)
        body, starts, of = held.windows(which, size)
        groups, lowest, samples = least_by_prefix(body, starts, held.lowest[which][of], size)
        k = np.arange(len(of)) - (np.cumsum(held.counts[which]) - held.counts[which])[of]
        runs.append((body, samples, lowest, groups, which[of], k))
    for body, samples, lowest, groups, string, k in runs:
        keys = np.ascontiguousarray(body[samples[:, None] + np.arange(size)])
        part = np.array([zlib.crc32(x) for x in keys.view(f"V{size}").ravel().tolist()], np.int64) % parts
        order = np.argsort(groups, kind="stable")
        times = per[string]
        for j in np.unique(part):
            own = np.flatnonzero(part == j)
            inside = order[part[groups[order]] == j]
            members = np.repeat(inside, times[inside])
            offset = np.arange(len(members)) - np.repeat(np.cumsum(times[inside]) - times[inside], times[inside])
            m = member_order[first_member[string[members]] + offset]
            per_key = np.bincount(groups[members], minlength=len(samples))[own]
            yield (
                int(j), keys[own].tobytes(), lowest[own].astype("<i8").tobytes(), per_key.astype("<i8").tobytes(), held.block[m].astype("<i4").tobytes(),
                held.name[m].astype("<u4").tobytes(), k[members].astype(np.uint8).tobytes(), held.least[m].astype("<i8").tobytes(),
            )


def merged_runs(rows: pa.Table, size: int) -> Iterator[tuple]:
    unpack = lambda name, kind: [np.frombuffer(x, kind) for x in column(rows, name)]
    keys, least = unpack("keys", f"S{size}"), unpack("least", "<i8")
    lowest = merged_least(list(zip(keys, least)))
    lowest = np.concatenate([np.repeat(a, n) for a, n in zip(lowest, unpack("times", "<i8"))])
    block, name, at, own = (np.concatenate(unpack(c, kind)) for c, kind in (("block", "<i4"), ("name", "<u4"), ("at", np.uint8), ("own", "<i8")))
    earlier = lowest < own
    yield from marks_by_block(block[earlier].astype(np.int64), name[earlier].astype(np.int64), at[earlier])


def cleaned_block(block: Block, found: pa.Table) -> tuple[list, list, list, list, list]:
    """Of every text of a block: key, bytes, bytes removed, maximal runs removed, what is left."""
    n = len(block.body)
    depth = np.zeros(n + 1, np.int32)
    if len(block.starts):
        name, least = block.names()
        later = np.flatnonzero(block.key[block.docs] > least)
        np.add.at(depth, block.starts[later], 1)
        np.add.at(depth, block.starts[later] + block.counts[later] + block.size - 1, -1)
        marks = np.zeros(len(name), np.uint64)
        for names, bits in zip(column(found, "names"), column(found, "marks")):
            marks[np.frombuffer(names, "<u4")] |= np.frombuffer(bits, "<u8")
        marks = marks[name]
        rest = np.flatnonzero((marks > 0) & (block.key[block.docs] == least))
        for j in range(LONGEST):
            own = block.starts[rest[(marks[rest] >> np.uint64(j)) & np.uint64(1) > 0]] + j
            np.add.at(depth, own, 1)
            np.add.at(depth, own + block.size, -1)
    gone = np.cumsum(depth[:-1]) > 0
    counted = np.concatenate([[0], np.cumsum(gone)])
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    inner = block.ends[(block.ends > 0) & (block.ends < n)]
    first[inner] = gone[inner]  # a run never goes on into the next text
    spans = np.concatenate([[0], np.cumsum(first)])
    left = block.body[~gone].tobytes()
    sizes, removed = np.diff(block.ends), np.diff(counted[block.ends])
    begins = block.ends - counted[block.ends]
    kept = [left[a:b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
    return block.keys, sizes, removed, np.diff(spans[block.ends]), kept


def _rows(found: Iterator[tuple], schema: pa.Schema) -> pa.Table:
    made = list(found)
    return pa.Table.from_arrays([pa.array([r[i] for r in made], f.type) for i, f in enumerate(schema)], schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split(" ") for f in text.split(", "))])


def remove_earlier_bytes(docs: DataFrame, size: int = 50, seed: int = 16, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """Every row's key, n_bytes, n_removed, n_spans and `kept` (binary): its UTF-8 bytes without those covered by
    a string of `size` bytes that also starts in a row with a smaller key.

    Keys are whole numbers. Windows are judged on the input. Rows with one key are not earlier than each other and all
    lose what a smaller key has. Rows with a null key keep all and are no place to be found in. A null text
    is empty; an empty or shorter one keeps all. An empty table gives an empty one. Other columns are not read.
    """
    if not 1 <= seed <= size or size - seed + 1 > LONGEST:
        raise ValueError(f"seed must be from size - {LONGEST - 1} to size")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = 2 * n
    # Copies of a row are spread by the partition they are read in, whatever their number.
    number = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`").cast("string")), F.spark_partition_id()), F.lit(count)).cast("int")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    blocks = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), body.alias("body"), number.alias("block")).repartition(n, "block")

    def anchors(rows: pa.Table) -> pa.Table:
        return _rows(sent_anchors(Block(rows, size, seed), rows.column("block")[0].as_py(), count), _schema(ANCHORS))

    def judge(rows: pa.Table) -> pa.Table:
        return _rows(judged_anchors(rows, hot), _schema(FLAGS))

    def send(rows: pa.Table, flags: pa.Table) -> pa.Table:
        if not len(rows):
            return _rows(iter(()), _schema(STRINGS))
        return _rows(sent_strings(Block(rows, size, seed), rows.column("block")[0].as_py(), flags, count), _schema(STRINGS))

    def shard(rows: pa.Table) -> pa.Table:
        return _rows(found_in_shard(rows, size), _schema(FOUND))

    def runs(rows: pa.Table) -> pa.Table:
        return _rows(sorted_runs(rows, size, count), _schema(RUNS))

    def merge(rows: pa.Table) -> pa.Table:
        return _rows(merged_runs(rows, size), _schema(FOUND))

    def clean(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table([pa.array([], f.type) for f in result], schema=result)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cleaned_block(Block(rows, size, seed), found), result)], schema=result)

    result = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    flags = blocks.groupBy("block").applyInArrow(anchors, ANCHORS).groupBy("rank").applyInArrow(judge, FLAGS)
    strings = blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(send, STRINGS).repartition(n, "shard")
    merged = strings.groupBy("shard").applyInArrow(runs, RUNS).groupBy("part").applyInArrow(merge, FOUND)
    found = strings.groupBy("shard").applyInArrow(shard, FOUND).unionByName(merged)
    out = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(clean, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("doc", key)
