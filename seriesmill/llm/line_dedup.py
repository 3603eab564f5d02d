"""Lines that an earlier document has already, removed from later ones after aligning both.

1. Every line's hash and length.
2. A document's evidence: from each line that is not blank, the shortest runs of adjacent lines
   forwards and backwards that have `min_chars` characters. In a block that is long enough to be
   removed, each such line lies in one of these runs, so no block goes unseen. A run leads to
   the earliest document that has it, never to all of them, so the pairs are no more than the
   shared runs, however many copies there are.
3. Each pair is aligned by patience diff: lines that are unique in both are anchors, the longest
   ascending run of anchors holds, and the gaps between are treated alike. In a gap without
   anchors the common block with most characters holds, and what lies before and after it is
   treated alike.
4. Aligned blocks of at least `min_chars` characters are removed from the later document. What
   counts is the input: a line stays in the earliest document that has it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import SPACES, computed, fresh, small_batches, stored
from seriesmill.llm.stars import attach, meet

MIN_CHARS = 60
# Base of the hash of several lines.
ODD = 0x9E3779B97F4A7C15


def ascending(values: list[int]) -> list[int]:
    """Indices of a longest ascending run (not necessarily adjacent) of distinct values."""
    tops, last, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        before[i] = last[k - 1] if k else -1
        tops[k : k + 1] = [v]
        last[k : k + 1] = [i]
    run, i = [], last[-1] if last else -1
    while i >= 0:
        run.append(i)
        i = before[i]
    return run[::-1]


def heaviest_block(a: list, b: list, size: Callable) -> tuple[int, int, int, int]:
    """Start in `a`, start in `b`, number of lines and characters of the common block with most
    characters, by a suffix automaton of `b`: time and memory grow with the lines, not their pairs."""
    follow, link, longest, ends, last = [{}], [-1], [0], [0], 0
    for j, line in enumerate(b, 1):
        now, p = len(follow), last
        follow.append({}), link.append(0), longest.append(j), ends.append(j)
        while p >= 0 and line not in follow[p]:
            follow[p][line] = now
            p = link[p]
        if p >= 0:
            q = follow[p][line]
            if longest[q] == longest[p] + 1:
                link[now] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q])), link.append(link[q]), longest.append(longest[p] + 1), ends.append(ends[q])
                while p >= 0 and follow[p].get(line) == q:
                    follow[p][line] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    upto, best = [0, *accumulate(map(size, a))], (0, 0, 0, 0)
    state = n = 0
    for i, line in enumerate(a, 1):
        while state and line not in follow[state]:
            state = link[state]
            n = longest[state]
        if line in follow[state]:
            state, n = follow[state][line], n + 1
        if (chars := upto[i] - upto[i - n]) > best[3]:
            best = (i - n, ends[state] - n, n, chars)
    return best


def patience(a: list, b: list, size: Callable = len, least: int = 1) -> list[tuple[int, int]]:
    """Aligned positions of equal lines, ascending in both. Gaps without anchors are aligned as
    long as a common block has `least` characters; `size` gives those of a line."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {line: i for i, line in enumerate(a[a0:a1], a0) if in_a[line] == 1 and in_b.get(line) == 1}
        anchors = [(place[line], j) for j, line in enumerate(b[b0:b1], b0) if line in place]
        run = [anchors[i] for i in ascending([i for i, _ in anchors])]
        found.extend(run)
        edges = [(a0 - 1, b0 - 1), *run, (a1, b1)]
        if run:
            todo.extend((p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:]) if p + 1 < r and q + 1 < s)
        elif not in_a.keys().isdisjoint(in_b):
            i, j, n, chars = heaviest_block(a[a0:a1], b[b0:b1], size)
            if chars >= least:
                i, j = a0 + i, b0 + j
                found.extend((i + k, j + k) for k in range(n))
                todo.extend([(a0, i, b0, j), (i + n, a1, j + n, b1)])
    return sorted(found)


def common_blocks(pairs: list[tuple[int, int]], sizes: list[int], min_chars: int) -> list[int]:
    """Positions in the later document of blocks (adjacent in both) that are long enough."""
    out, block = [], []
    for i, j in [*pairs, (-1, -1)]:
        if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(sizes[q] for _, q in block) >= min_chars:
                out.extend(q for _, q in block)
            block = []
        block.append((i, j))
    return out


def align(pairs: DataFrame, lines: DataFrame, min_chars: int) -> DataFrame:
    """For every pair the line positions to remove from `b`: node, removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in batches:
            nodes, removed = [], []
            for b, hashes, sizes in zip(*[batch.column(c).to_pylist() for c in ("b", "hashes", "sizes")]):
                own = list(zip(hashes, sizes))
                if b is None:
                    centre = own
                elif gone := common_blocks(patience(centre, own, itemgetter(1), min_chars), sizes, min_chars):
                    nodes.append(b)
                    removed.append(gone)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(removed, pa.list_(pa.int32()))], names=["node", "removed"])

    return meet(pairs, lines).mapInArrow(run, "node long, removed array<int>")


def runs_of_lines(hashes: np.ndarray, sizes: np.ndarray, begins: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """The shortest runs of `min_chars` characters from each line that is not blank, forwards and
    backwards within its document: the line each is found from, and a hash of its lines.

    `begins` has the first line of every document and the number of lines.
    """
    n = len(hashes)
    lengths = np.diff(begins)
    first, after = np.repeat(begins[:-1], lengths), np.repeat(begins[1:], lengths)
    at, upto = np.arange(n), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    forward = np.searchsorted(upto, upto[:-1] + min_chars)
    backward = np.searchsorted(upto, upto[1:] - min_chars, "right") - 1
    ahead, behind = (sizes > 0) & (forward <= after), (sizes > 0) & (backward >= first) & (upto[1:] >= min_chars)
    starts, ends = np.concatenate([at[ahead], backward[behind]]), np.concatenate([forward[ahead], at[behind] + 1])
    # Sums of hash * ODD ** position modulo 2 ** 64, taken back to position 0 by the inverse of ODD.
    powers, inverse = (np.cumprod(np.array([1] + [x] * n, np.uint64), dtype=np.uint64) for x in (ODD, pow(ODD, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * powers[:n], dtype=np.uint64)])
    run = (sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
    return np.concatenate([at[ahead], at[behind]]), run.view(np.int64)


def evidence(lines: DataFrame, min_chars: int) -> DataFrame:
    """doc, text_hash, node and run, once for each different run of lines of a document."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = batch.column("hashes"), batch.column("sizes")
            begins = np.asarray(hashes.offsets).astype(np.int64)
            if not begins[-1] > begins[0]:
                continue
            begins -= begins[0]
            found, run = runs_of_lines(hashes.flatten().to_numpy(), sizes.flatten().to_numpy(), begins, min_chars)
            row = np.searchsorted(begins, found, "right") - 1
            both = np.unique(np.rec.fromarrays([row, run], names="row,run"))
            kept = batch.select(["doc", "text_hash", "node"]).take(pa.array(both["row"]))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(both["run"])], names=["doc", "text_hash", "node", "run"])

    key_type = lines.schema["doc"].dataType.simpleString()
    return lines.mapInArrow(runs, f"doc {key_type}, text_hash long, node long, run long")


def removed_lines(docs: DataFrame, min_chars: int, key: str, text: str) -> DataFrame:
    """Documents that lose lines: doc, text_hash, removed (positions from 0, sorted)."""
    body = F.col("_text")
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("_text")).na.drop()
    rows = computed(rows, text_hash=F.xxhash64(body), lines=F.transform(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES))))
    # Blank lines align with each other but are no evidence.
    hashes = F.transform("lines", lambda line: F.when(line != "", F.xxhash64(line)).otherwise(F.lit(0)))
    lines = rows.select("doc", "text_hash", hashes.alias("hashes"), F.transform("lines", F.length).alias("sizes"))
    lines = stored(lines.withColumn("node", F.monotonically_increasing_id()), "lines")

    each = evidence(lines.select("doc", "text_hash", "node", "hashes", "sizes"), min_chars).select(F.struct("doc", "text_hash").alias("own"), "node", "run")
    each = stored(each, "line-runs")
    first = each.groupBy("run").agg(F.count("*").alias("n"), F.min(F.struct("own", "node")).alias("first")).filter("n > 1")
    shared = each.join(first, "run").filter("own > first.own")
    pairs = stored(shared.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct(), "line-pairs")

    gone = align(pairs, lines.select("node", "hashes", "sizes"), min_chars)
    gone = gone.select("node", F.explode("removed").alias("at")).groupBy("node").agg(F.array_sort(F.collect_set("at")).alias("removed"))
    names = lines.select("node", "doc", "text_hash")
    return stored(names.join(gone, "node").select("doc", "text_hash", "removed").dropDuplicates(["doc", "text_hash"]), "removed")


def without_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with the text left after removing shared lines, and the name of an added column with
    the positions (from 0) of the removed lines.

    Documents are ordered by key, rows with one key by a hash of their text; the earlier keeps the
    lines. Repeated rows (same key, same text) are one document and treated alike. Rows with a null
    key or text stay as they are; an empty text has one blank line, which never counts. A document
    that loses all lines keeps an empty text. Lines are compared without white space at their ends,
    by 64-bit hash and length. Other columns pass unchanged, whatever their names; an empty table
    gives an empty one.
    """
    small_batches(docs.sparkSession)
    gone = removed_lines(docs, min_chars, key, text)
    names = {n: fresh(docs, n) for n in ("_doc", "_hash", "_removed")}
    gone = gone.select(F.col("doc").alias(names["_doc"]), F.col("text_hash").alias(names["_hash"]), F.col("removed").alias(names["_removed"]))
    wide = docs.withColumns({names["_doc"]: F.col(f"`{key}`"), names["_hash"]: F.xxhash64(F.col(f"`{text}`").cast("string"))})
    out = attach(wide, gone, [names["_doc"], names["_hash"]])
    at = F.col(names["_removed"])
    left = F.array_join(F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda _, i: ~F.array_contains(at, i)), "\n")
    out = out.withColumn(text, F.when(at.isNull(), F.col(f"`{text}`")).otherwise(left))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], names["_removed"]), names["_removed"]
