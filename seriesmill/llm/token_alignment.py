"""Two tokenizations of a text side by side: groups between common byte offsets, and overlapping tokens.

A is a byte-level BPE vocabulary over a space and the text, B a piece vocabulary, which adds that
space itself. Both begin a new token at every single space between two other characters, so a text is
cut there, and equal segments are tokenised and aligned once.

Alignment works on the byte ends of the tokens. The shorter list is searched in the longer one by
galloping: from the segment's first token in steps of 1, 2, 4, ... and then by bisection, all ends
side by side. Ends found in both cut the tokens into groups; from the differences of the ranks found
follows which tokens of the other side overlap a token.

How many documents hold a pair of ids is counted in two steps: blocks of documents write each of their
pairs once, with the number of their documents; sums over blocks give the counts, and each block gets
the counts of its own pairs back. So no table of pairs is broadcast, and what moves is bounded by
the distinct pairs per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from seriesmill.llm.common import fresh, scratch_dir, small_batches
from seriesmill.llm.segments import Cache, Distinct, Encoder, slices

# Bytes of text per block of documents.
BLOCK_BYTES = 2 << 20
# Segments kept per generation of a worker's caches.
CACHED = 70_000


def gallop(targets: np.ndarray, ends: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For every target the first place in `ends` (ascending) at or after `begins` that is not smaller."""
    last = len(ends) - 1
    low, step = begins.copy(), np.ones(len(targets), np.int64)
    high = np.minimum(low, last)
    short = np.flatnonzero(ends[high] < targets)
    while len(short):
        low[short] = high[short] + 1
        high[short] = np.minimum(high[short] + step[short], last)
        step[short] *= 2
        short = short[ends[high[short]] < targets[short]]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less = ends[middle] < targets[open_]
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
        open_ = open_[low[open_] < high[open_]]
    return high


class Aligner:
    """Tokens of both vocabularies for segments, aligned, from a bounded cache."""

    def __init__(self, bpe: str, pieces: str):
        import sentencepiece

        self.a = Encoder(bpe, CACHED)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        a_bytes = {i: len(t) for t, i in self.a.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.a_size = np.array([a_bytes.get(i, 0) for i in range(max(a_bytes) + 1)], np.int64)
        b, n = self.b, self.b.get_piece_size()
        self.b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.b_size = np.array(list(map(len, self.b_bytes)), np.int64)
        self.width = n
        self.a_text, self.b_text = list(map(str, range(len(self.a_size)))), list(map(str, range(n)))
        self.cache = Cache(self._align, CACHED)

    def _align(self, keys: list) -> list[tuple]:
        """Per segment: tokens of A and B, groups, their text, and codes of the linked pairs; 0 tokens if the bytes differ."""
        raws = [" " + k if isinstance(k, str) else k[0] for k in keys]
        a_ids = [np.frombuffer(x, self.a.dtype) for x in self.a.cache.values(keys)]
        b_ids = self.b.encode([r[1:] for r in raws], num_threads=1)
        pieces = self.b_bytes
        good = [bool(raw) and b"".join([pieces[i] for i in ids]) == raw.encode() for raw, ids in zip(raws, b_ids)]
        rows = [i for i, g in enumerate(good) if g]
        out: list[tuple] = [(0, 0, 0, "", b"")] * len(keys)
        if not rows:
            return out
        na, nb = (np.array([len(x[i]) for i in rows], np.int64) for x in (a_ids, b_ids))
        a = np.concatenate([a_ids[i] for i in rows]).astype(np.int64)
        b = np.fromiter((x for i in rows for x in b_ids[i]), np.int64, int(nb.sum()))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        if len(a) <= len(b):
            first, last, common_a, common_b = self._ranges(a_end, b_end, np.repeat(np.cumsum(nb) - nb, na))
            left = np.repeat(np.arange(len(a)), last - first + 1)
            right = np.arange(len(left)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[left]
        else:
            first, last, common_b, common_a = self._ranges(b_end, a_end, np.repeat(np.cumsum(na) - na, nb))
            right = np.repeat(np.arange(len(b)), last - first + 1)
            left = np.arange(len(right)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[right]
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
        codes = (a[left] * self.width + b[right]).astype("<i8").tobytes()
        links = np.searchsorted(left, np.concatenate([[0], np.cumsum(na)])).tolist()
        groups = np.searchsorted(common_a, np.cumsum(na)).tolist()  # the first group of the next segment is one further on
        a_cut, b_cut = [0, *(common_a + 1).tolist()], [0, *(common_b + 1).tolist()]
        a_text, b_text = [self.a_text[i] for i in a.tolist()], [self.b_text[i] for i in b.tolist()]
        texts = [",".join(a_text[p:q]) + "|" + ",".join(b_text[r:s]) for p, q, r, s in zip(a_cut, a_cut[1:], b_cut, b_cut[1:])]
        at = 0
        for k, i in enumerate(rows):
            to = groups[k]
            out[i] = (int(na[k]), int(nb[k]), to - at, ";".join(texts[at:to]), codes[8 * links[k] : 8 * links[k + 1]])
            at = to
        return out

    @staticmethod
    def _ranges(short: np.ndarray, long: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        """For tokens of the shorter list the first and last token of the other that overlap; the places of common ends."""
        rank = gallop(short, long, begins)
        equal = long[rank] == short
        first = np.concatenate([[0], (rank + equal)[:-1]])
        common = np.flatnonzero(equal)
        return first, rank, common, rank[common]

    def segments(self, texts: pa.Array) -> Distinct:
        """The segments of a space and each text."""
        parts = Distinct(texts)
        for i, k in enumerate(parts.keys):
            if isinstance(k, tuple):
                parts.keys[i] = k[0] if k[0] and not k[0][0].isspace() else (" " + k[0] if k[0] else "",)
        return parts

    def align(self, texts: pa.Array) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Counts per text, group texts, and the distinct linked pairs of each: text, code, times."""
        parts = self.segments(texts)
        values = self.cache.values(parts.keys)
        codes, offsets = parts.codes, parts.offsets
        counts = {name: np.fromiter((v[j] for v in values), np.int64, len(values)) for j, name in enumerate(("n_a", "n_b", "n_groups"))}
        bad = np.add.reduceat(np.append((counts["n_a"] == 0)[codes], 0), offsets[:-1]) > 0 if len(codes) else np.zeros(0, bool)
        spell = [v[3] for v in values]
        flat = codes.tolist()
        groups = ["" if x else ";".join([spell[c] for c in flat[p:q]]) for x, p, q in zip(bad.tolist(), offsets[:-1].tolist(), offsets[1:].tolist())]
        pairs, local = np.unique(np.frombuffer(b"".join(v[4] for v in values), "<i8"), return_inverse=True)
        size = np.fromiter((len(v[4]) for v in values), np.int64, len(values)) // 8
        text = np.repeat(np.arange(len(bad)), np.diff(offsets))
        live = ~bad[text]
        codes, text = codes[live], text[live]
        totals = {name: np.bincount(text, x[codes], len(bad)).astype(np.int64) for name, x in counts.items()}
        totals["n_links"] = np.bincount(text, size[codes], len(bad)).astype(np.int64)
        each = size[codes]
        begin = (np.cumsum(size) - size)[codes]
        at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begin, each)
        keys = (np.repeat(text, each).astype(np.uint64) << np.uint64(32)) | local[at].astype(np.uint64)
        keys.sort()
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(keys)))
        keys = keys[new]
        used, local = np.unique(keys & np.uint64(0xFFFFFFFF), return_inverse=True)
        return totals, groups, (keys >> np.uint64(32)).astype(np.int64), pairs[used.astype(np.int64)], np.stack([local, times])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(bpe: str, pieces: str) -> Aligner:
    if (bpe, pieces) not in _ALIGNERS:
        _ALIGNERS[bpe, pieces] = Aligner(bpe, pieces)
    return _ALIGNERS[bpe, pieces]


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align_documents(docs: DataFrame, bpe: str, pieces: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents aligned, and the pairs of ids linked in each block of them, both written down.

    Documents: key, block, n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2`, ids of A and B per group) and
    `links`, which `score_links` reads (places of the block's pairs and how often each occurs). Pairs: block, place, a, b,
    documents. A null or empty text, and one whose bytes either vocabulary doesn't give back, has no
    tokens: zeros and an empty `groups`. Every row is a document of its own, also repeated ones and
    those with a null key. An empty table gives empty tables. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, place int, a int, b int, documents long, block long, of string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, block = aligner(bpe, pieces), (TaskContext.get().partitionId() << 32) - 1
        for whole in batches:
            for batch in slices(whole, BLOCK_BYTES):
                if not len(batch):
                    continue
                block += 1
                totals, groups, doc, pairs, (local, times) = both.align(batch.column(1))
                n, m = len(batch), len(pairs)
                cut = np.searchsorted(doc, np.arange(n + 1)).tolist()
                places, often = local.astype("<u4"), np.minimum(times, 1 << 31).astype("<u4")
                links = [places[p:q].tobytes() + often[p:q].tobytes() for p, q in zip(cut, cut[1:])]
                columns = [batch.column(0), *[pa.array(totals[c]) for c in COUNTS], pa.array(groups, pa.string()), pa.array(links, pa.binary())]
                nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *nothing, pa.array([block] * n, pa.int64()), pa.array(["documents"] * n, pa.string())], names=names)
                held = np.bincount(local, minlength=m).astype(np.int64)
                own = [pa.array(np.arange(m, dtype=np.int32)), *[pa.array(x.astype(np.int32)) for x in np.divmod(pairs, both.width)], pa.array(held)]
                nothing = [pa.nulls(m, c.type) for c in columns]
                yield pa.RecordBatch.from_arrays([*nothing, *own, pa.array([block] * m, pa.int64()), pa.array(["pairs"] * m, pa.string())], names=names)

    names = ["doc", *COUNTS, "groups", "links", "place", "a", "b", "documents", "block", "of"]
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    folder = scratch_dir(spark, "aligned")
    rows.mapInArrow(run, schema).write.partitionBy("of").option("compression", "zstd").parquet(folder)
    written = lambda of: spark.read.schema(schema).parquet(folder).filter(F.col("of") == of)
    documents = written("documents").select(F.col("doc").alias(key), "block", *COUNTS, "groups", "links")
    return documents, written("pairs").select("block", "place", "a", "b", "documents")


def link_counts(pairs: DataFrame) -> DataFrame:
    """For every pair of ids a, b: the number of documents that link them, and whether no other b has more for this a.

    The window of an `a` has at most as many rows as B has ids.
    """
    counts = pairs.groupBy("a", "b").agg(F.sum("documents").alias("documents"))
    return counts.withColumn("is_best", F.col("documents") == F.max("documents").over(W.partitionBy("a")))


def score_links(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of `align_documents` with whatever columns they have, `links` replaced by n_best and count_sum."""
    if "links" not in documents.columns or fresh(documents, "n_best") != "n_best" or fresh(documents, "count_sum") != "count_sum":
        raise ValueError("documents need a column links, and no columns n_best and count_sum")
    replies = pairs.select("block", "place", "a", "b").join(link_counts(pairs), ["a", "b"]).select("block", "place", "documents", "is_best")
    carried = [c for c in documents.columns if c != "links"]
    fields = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carried)

    def score(rows: pa.Table, counts: pa.Table) -> pa.Table:
        size = len(counts)
        documents, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        place = np.asarray(counts.column("place"))
        documents[place], best[place] = np.asarray(counts.column("documents")), np.asarray(counts.column("is_best")).astype(np.int64)
        n_best, count_sum = [], []
        for packed in rows.column("links").to_pylist():
            at, times = np.frombuffer(packed, "<u4").reshape(2, -1).astype(np.int64)
            n_best.append(int(best[at] @ times))
            count_sum.append(int(documents[at] @ times))
        out = rows.select(carried)
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

    return documents.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, f"{fields}, n_best long, count_sum long")
