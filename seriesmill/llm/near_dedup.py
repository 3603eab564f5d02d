"""Near-duplicate documents: one-permutation MinHash, banded buckets, stars, exact confirmation.

1. Sketch: a document's shingle hashes fall into bins by their high bits; a bin keeps its smallest.
   An empty bin borrows from a filled one by a random sequence of its own (optimal densification).
   Bands of `ROWS` bins make `BANDS` bucket keys. At a similarity of 0.8 a pair shares no bucket
   with probability (1 - 0.8^6)^40, about 5 in a million.
2. Documents with the same shingle set are one class; only one of each goes on.
3. In a bucket only edges from its most central class to the others are candidates: a star.
4. An edge is confirmed on the full sets. A centre's text is sent once per salt, not per member.
5. What a star leaves open are pairs of two components, of which one member at least is no link of
   the centre. They are found by what differs from the centre: with D(x) the shingles that x and the
   centre do not share, x and y are linked if and only if |D(x)| + |D(y)| - 2 |D(x) & D(y)| is at most
   1/9 of |x| + |y| (for a similarity of 0.8). So the two differ from the centre in the same way
   to a large part, and a prefix filter joins them on the rarest shingles of their differences, with bounds
   by size and position. A third of all documents around one centre makes few such pairs. Classes of quite
   another size than the centre are joined in the same way by their whole sets (an empty centre).
   So every pair that shares a bucket is confirmed, refuted, or known to be in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import fresh, small_batches, stored
from seriesmill.llm.components import relabel
from seriesmill.llm.segments import slices
from seriesmill.llm.shingles import digest, mix, shingle_sets
from seriesmill.llm.stars import meet, narrowed

ROWS, BANDS = 6, 40
BINS = ROWS * BANDS
# Stars after the first, before what is open is joined by differences.
STAR_ROUNDS = 0
# Differences are taken from a centre of at least half and at most twice the size; the rest, and what may be linked with them, are joined as they are.
LIKE = 0.5


def donors(block: int, tries: int) -> np.ndarray:
    """For each bin the filled bins it asks, in order: `tries` rows of one random sequence per bin."""
    seeds = np.arange(tries, dtype=np.uint64)[:, None] + np.uint64(block * 1_000_003 + 17)
    return (mix(seeds * np.uint64(0x9E3779B97F4A7C15) + np.arange(BINS, dtype=np.uint64)) % np.uint64(BINS)).astype(np.int64)


_DONORS: dict[int, np.ndarray] = {}


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin of a sorted, non-empty set, empty bins densified."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.concatenate([[True], bins[1:] != bins[:-1]])
    out, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    at = bins[first].astype(np.int64)
    out[at], filled[at] = hashes[first], True
    empty, block = np.flatnonzero(~filled), 0
    while len(empty):
        if block not in _DONORS and block < 8:
            _DONORS[block] = donors(block, 64 if block == 0 else 512)
        table = _DONORS[block] if block in _DONORS else donors(block, 512)
        asked = table[:, empty]
        good = filled[asked]
        found = good.any(axis=0)
        out[empty[found]] = out[asked[good.argmax(axis=0)[found], np.flatnonzero(found)]]
        empty, block = empty[~found], block + 1
    return out


def sketch(docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """Key, hash of the text, n_shingles, digest of the set, bucket keys (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for whole in batches:
            for batch in slices(whole):
                sets = shingle_sets(batch.column(2), shingle)
                full = [s for s in sets if len(s)]
                signs = np.array([signature(s) for s in full], np.uint64).reshape(len(full), BANDS, ROWS)
                keys = np.broadcast_to(salt, (len(full), BANDS)).copy()
                for r in range(ROWS):
                    keys = mix(keys + signs[:, :, r])
                bands = iter(keys.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc", "text_hash", "n", "digest", "bands"],
                )

    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    schema = f"doc {docs.schema[key].dataType.simpleString()}, text_hash long, n long, digest binary, bands array<long>"
    return rows.mapInArrow(run, schema)


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The text that stands for each class: node, text."""
    nodes = stored(nodes.join(classes, "node").select("node", F.col("rep").alias("doc"), "text_hash"), "nodes")
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    on = ["doc", "text_hash"]
    return narrowed(rows, nodes.select(*on), on).join(nodes, on).select("node", "text")


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int, key: str, text: str, differences: bool = False) -> DataFrame:
    """`pairs` (a, b), each once, with the sizes of both sets and `linked`, by the full sets.

    With `differences`: `delta`, the shingles that one of them has alone, if they are alike in size, and `own`, those of b, if not.
    """
    pairs = stored(pairs, "pairs")
    texts = texts_of(pairs.select("a").union(pairs.select("b")).distinct().toDF("node"), classes, docs, key, text)

    unlike = LIKE * 100 / percent + 0.01

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for whole in batches:
            for batch in slices(whole, (2 if differences else 12) << 20):
                rows = []
                for a, b, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), shingle_sets(batch.column(3), shingle)):
                    if b is None:
                        centre = own
                        continue
                    common = len(np.intersect1d(centre, own, assume_unique=True))
                    union = len(centre) + len(own) - common
                    ratio = min(len(centre), len(own)) / max(len(centre), len(own))
                    delta = np.setxor1d(centre, own, assume_unique=True).view(np.int64) if differences and ratio >= LIKE else None
                    rows.append((a, b, len(centre), len(own), common * 100 >= percent * union, delta, own.view(np.int64) if differences and ratio < unlike else None))
                columns = list(zip(*rows)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, made)], schema=made)

    numbers = pa.list_(pa.int64())
    made = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("linked", pa.bool_()), ("delta", numbers), ("own", numbers)])
    found = meet(pairs, texts).mapInArrow(compare, "a long, b long, n_a long, n_b long, linked boolean, delta array<long>, own array<long>")
    return stored(found if differences else found.drop("delta", "own"), "confirmed")


def placed_sizes(buckets: DataFrame) -> DataFrame:
    """For every class how many others its buckets hold: the most central one of a group has the most."""
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size"))
    return buckets.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("degree"))


def pairs_by_difference(open_rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of two components that may be links, from rows of centre, node, label, n_a (the centre's size), n_b, delta, own.

    Two sets with at least t common elements share one among the first d - t + 1 of each, whatever the order; here
    the rarest come first. Elements that only one component has, or no class that the centre is not linked with,
    cannot be common to such a pair and come before all others.
    """
    rate = (100 - percent) / (100 + percent)  # of both sizes, that may differ
    small = 1e-9
    bases = F.array(
        F.struct(F.lit(1).alias("base"), F.col("n_a").cast("double").alias("nc"), F.col("delta").alias("tokens")),
        F.struct(F.lit(0).alias("base"), F.lit(0.0).alias("nc"), F.col("own").alias("tokens")),
    )
    rows = open_rows.select("centre", "node", "label", F.col("n_b").alias("n"), F.inline(bases)).filter("tokens is not null")
    d, n, nc = F.size("tokens").cast("double"), F.col("n"), F.col("nc")
    outside = d > rate * (n + nc) + small
    least = F.when(F.col("base") == 0, n * (percent / 100)).otherwise(
        F.when(outside, F.least((1 - rate) / 2 * d, (d - rate * (n + nc)) / 2 + (1 - rate) / 2)).otherwise((1 - rate) / 2 * d)
    )
    rows = rows.withColumns({"d": d, "outside": outside, "prefix": d - F.greatest(F.ceil(least - small), F.lit(1)) + 1})
    group = ["centre", "base"]
    # A group has pairs only with two components and a class that its centre is not linked with.
    alive = rows.groupBy(*group).agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("outside").alias("any")).filter("low != high and any")
    rows = stored(rows.join(alive.select(*group), group), "differences")
    each = rows.select(*group, "node", "label", "outside", F.explode("tokens").alias("token"))
    shared = each.groupBy(*group, "token").agg(F.count("*").alias("times"), F.min("label").alias("low"), F.max("label").alias("high"), F.max("outside").alias("any"))
    shared = shared.filter("low != high and any").select(*group, "token", "times")
    listed = each.join(shared, [*group, "token"]).groupBy(*group, "node").agg(F.array_sort(F.collect_list(F.struct("times", "token"))).alias("common"))
    placed = listed.join(rows.drop("tokens"), [*group, "node"])
    placed = placed.select(*group, "node", "label", "n", "d", "outside", "prefix", F.size("common").alias("c"), F.posexplode("common").alias("at", "entry"))
    placed = placed.withColumn("at", F.col("d") - F.col("c") + F.col("at")).filter("at < prefix")
    placed = stored(placed.select(*group, F.col("entry.token").alias("token"), "node", "label", "n", "d", "outside", "at"), "prefixes")
    left = placed.filter("outside").drop("outside")
    right = placed.select(*group, "token", *[F.col(c).alias(f"{c}_") for c in ("node", "label", "n", "d", "at", "outside")])
    needed = (F.col("d") + F.col("d_") - rate * (F.col("n") + F.col("n_"))) / 2
    possible = F.least(F.col("d") - F.col("at"), F.col("d_") - F.col("at_"))
    sized = F.least("n", "n_") * 100 >= F.greatest("n", "n_") * percent
    once = ~F.col("outside_") | (F.col("node") < F.col("node_"))
    right = right.withColumnsRenamed({c: f"{c}_r" for c in (*group, "token")})
    on = [F.col(c) == F.col(f"{c}_r") for c in (*group, "token")] + [F.col("label") != F.col("label_"), once, sized, possible + small >= needed]
    found = left.join(right, on)
    return found.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's key, n_shingles, component_id (the smallest key it can reach by links, itself
    included), kept (it is that one), and text_hash.

    Documents are linked if their sets of `shingle`-word shingles share at least `percent` of their
    union. A null or empty text, or one of white space, has no shingle and links with nothing. Rows with a null
    key take no part: their component is null and they are kept. Rows that share a key are one
    document's: each is linked by its own text, repeated rows agree. An empty table gives an empty
    one. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    sketched = stored(sketch(docs, shingle, key, text), "sketch")
    linkable = sketched.filter(F.col("doc").isNotNull() & F.col("digest").isNotNull())
    least = F.min(F.struct("doc", "text_hash")).alias("least")
    classes = linkable.groupBy("digest").agg(least, F.max("n").alias("n"))
    classes = classes.select("digest", F.col("least.doc").alias("rep"), F.col("least.text_hash").alias("text_hash"), "n")
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    reps = linkable.select("digest", F.col("doc").alias("rep"), "text_hash", "bands").join(classes, ["digest", "rep", "text_hash"])
    placed = reps.select("node", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high").select("bucket")
    buckets = stored(placed.join(shared, "bucket").distinct(), "buckets")

    sizes = placed_sizes(buckets)
    names = classes.select("node", F.col("node").alias("label"))
    open_rows = buckets.join(sizes, "node").select("bucket", "node", "degree", F.col("node").alias("label"))
    for _ in range(STAR_ROUNDS + 1):
        centre = open_rows.groupBy("bucket").agg(F.max(F.struct("degree", -F.col("node"))).alias("c")).select("bucket", (-F.col("c.col2")).alias("centre"))
        star = stored(open_rows.join(centre, "bucket").filter("node != centre").drop("label"), "star")
        confirmed = confirm(star.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), classes, docs, shingle, percent, key, text, True)
        names = relabel(names, confirmed.filter("linked").select("a", "b"))
        # Centres are done with; a bucket stays open while the others are of several components.
        rest = star.join(names, "node")
        split = rest.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("bucket")
        rest = stored(rest.join(split, "bucket", "semi"), "open")
        open_rows = rest.drop("centre")
    still = rest.select("centre", "node", "label").distinct().join(confirmed.drop("linked").withColumnsRenamed({"a": "centre", "b": "node"}), ["centre", "node"])
    confirmed = confirm(pairs_by_difference(still, percent), classes, docs, shingle, percent, key, text)
    names = relabel(names, confirmed.filter("linked").select("a", "b"))
    named = classes.join(names, "node")
    least_key = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(least_key, "label").select("digest", "component_id")
    out = sketched.select("doc", "text_hash", "n", F.when(F.col("doc").isNotNull(), F.col("digest")).alias("digest")).join(named, "digest", "left")
    component = F.coalesce("component_id", "doc")
    return out.select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
        "text_hash",
    )


def without_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` whose document is the smallest of its component; all columns.

    A document is a key and a text: repeated rows stay together. See `near_duplicates`.
    """
    gone = near_duplicates(docs, shingle, percent, key, text).filter("not kept")
    gone = stored(gone.select(F.col(f"`{key}`").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "gone")
    names = [fresh(docs, "_doc"), fresh(docs, "_hash")]
    wide = docs.withColumns({names[0]: F.col(f"`{key}`"), names[1]: F.xxhash64(F.col(f"`{text}`").cast("string"))})
    return narrowed(wide, gone.toDF(*names), names, "anti").drop(*names)
