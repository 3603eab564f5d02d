"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

The best segmentation of a prefix does not depend on what follows, so pre-tokens with a common
prefix share its scores: distinct pre-tokens are inserted in a trie, and a node's forward score
(best log probability of its prefix, and the number of pieces, fewer on ties) is computed once,
when the node is made. The node where a pre-token ends holds its count.

Pieces and their order come from a public vocabulary file; their probabilities follow the order by
Zipf's law. Every task has a trie of its own, emptied beyond `MAX_NODES`: that costs
repeated work, never a different result.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import small_batches
from seriesmill.llm.segments import Cache, Distinct, segment_text, slices

MAX_NODES = 400_000


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file, the most frequent first. All single bytes must be among them."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


def zipf_scores(pieces: list[bytes]) -> dict[bytes, float]:
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -math.log(r + 1) - total for r, p in enumerate(pieces)}


class Trie:
    """Forward scores of all prefixes met so far."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        self.scores, self.max_nodes = scores, max_nodes
        self.suffixes = {p[i:] for p in scores for i in range(len(p))}
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, int], int] = {}
        self.best, self.count = [0.0], [0]

    def count_pieces(self, token: bytes) -> int:
        if len(self.best) + len(token) > self.max_nodes and len(self.best) > 1:
            self.clear()
        children, best, count, scores, suffixes = self.children, self.best, self.count, self.scores, self.suffixes
        path = [0]
        node = 0
        for end, byte in enumerate(token, 1):
            child = children.get((node, byte))
            if child is None:
                child = len(best)
                children[node, byte] = child
                top = None
                for begin in range(end - 1, -1, -1):
                    piece = token[begin:end]
                    if piece not in suffixes:
                        break
                    score = scores.get(piece)
                    if score is not None:
                        at = path[begin]
                        found = (best[at] + score, -count[at] - 1)
                        if top is None or found > top:
                            top = found
                best.append(top[0])
                count.append(-top[1])
            path.append(child)
            node = child
        return count[node]


_COUNTERS: dict[str, Cache] = {}


def counter(path: str) -> Cache:
    """Pre-tokens and pieces of a segment, one cache and trie per Python worker."""
    if path not in _COUNTERS:
        import public_tokenizers
        import regex

        pattern, trie = regex.compile(public_tokenizers.PATTERN), Trie(zipf_scores(read_pieces(path)))

        def make(keys: list) -> list[tuple[int, int]]:
            tokens = [pattern.findall(segment_text(k)) for k in keys]
            distinct = sorted({t for ts in tokens for t in ts})
            pieces = {t: trie.count_pieces(t.encode()) for t in distinct}
            return [(len(ts), sum(pieces[t] for t in ts)) for ts in tokens]

        _COUNTERS[path] = Cache(make)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's key, n_pretokens and n_tokens (pieces of the best segmentation).

    A null or empty text has none of either. Repeated rows are counted each, null keys stay null,
    an empty table gives an empty one, other columns are not read.
    """
    small_batches(docs.sparkSession)
    schema = f"_key {docs.schema[key].dataType.simpleString()}, n_pretokens long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = counter(vocabulary)
        for whole in batches:
            for batch in slices(whole):
                parts = Distinct(batch.column(1))
                values = np.array(cache.values(parts.keys), np.int64).reshape(-1, 2)[parts.codes]
                sums = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(values, axis=0)])
                per = sums[parts.offsets[1:]] - sums[parts.offsets[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(per[:, 0].copy()), pa.array(per[:, 1].copy())], names=["_key", "n_pretokens", "n_tokens"]
                )

    out = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)
    return out.withColumnRenamed("_key", key)
