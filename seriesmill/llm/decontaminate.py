"""Benchmark passages in training text, by a positional inverted index.

1. Phrases: every run of `words` words of a benchmark item (the whole item if it is shorter).
2. Frequencies of the benchmark's terms over all documents, combined before the shuffle.
3. For every phrase its rarest terms; the index keeps the postings (term, document, position) of
   these anchor terms and is written to the shared folder.
4. Postings of the rarest term, shifted by its offset in the phrase, give starts; those that the
   shifted list of the second rarest term shares remain (`intersect`).
5. The remaining terms are looked up in the documents that still have candidates: a start that
   has the right term at every offset is an occurrence.

A term that fills the corpus is an anchor only of phrases made of such terms alone. Its postings
are dealt out by document and position, never by term, so no task gets a whole list.

Postings and candidates grow with the corpus and are read back from written tables. Spark would
broadcast those by the size of their files, in which repeated words take a small part of the room
they take in memory, so their joins are merge joins by a hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from seriesmill.llm.common import NON_TOKEN_RUN, ascii_lower, fresh, split_words, stored
from seriesmill.llm.stars import narrowed
from seriesmill.operators.joins import join_sized

ANCHORS = 2


def tokens(text: Column) -> Column:
    """Words of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z lowered; none for null."""
    return split_words(ascii_lower(text), NON_TOKEN_RUN)


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, hash of the text and words. Rows that share both have the same text, so the same result."""
    body = F.col(f"`{text}`")
    return docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(body).alias("digest"), tokens(body).alias("w"))


def same_doc(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on document key (null equals null) and digest, keeping the columns of `a`."""
    other = b.withColumnsRenamed({"doc": "_doc", "digest": "_digest"})
    out = a.join(other, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")), how)
    return out.drop("_doc", "_digest") if how not in ("semi", "anti") else out


def item_phrases(items: DataFrame, words: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """Each different phrase once: id, words and the items (as strings) that have it."""
    w = items.select(F.col(f"`{key}`").cast("string").alias("item"), tokens(F.col(f"`{text}`")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (words - 1), F.lit(1)))
    each = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, words))).alias("phrase"))
    return each.groupBy("phrase").agg(F.collect_set("item").alias("items")).withColumn("phrase_id", F.monotonically_increasing_id())


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of `terms` occurs in `docs` (of `keyed`); terms that never occur are left out."""
    return join_sized(docs.select(F.explode("w").alias("term")), terms, ["term"], "inner").groupBy("term").agg(F.count("*").alias("n"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of `terms` in `docs` (of `keyed`), written to the shared folder: term, doc, digest, at.

    Repeated rows (same key, same text) repeat their postings.
    """
    postings = docs.select("doc", "digest", F.posexplode("w").alias("at", "term"))
    return stored(join_sized(postings, terms, ["term"], "inner"), "postings")


def rarest(terms: DataFrame, counts: DataFrame, of: str, most: int) -> DataFrame:
    """The `most` rarest terms of every `of` with their rank; without any `of` that has an absent term."""
    with_n = terms.join(counts, "term", "left").withColumn("_all", F.min(F.coalesce("n", F.lit(0))).over(W.partitionBy(of)))
    order = W.partitionBy(of).orderBy("n", "term", "at")
    return with_n.filter("_all > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).drop("_all")


def phrase_starts(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """Starts that the shifted lists of all anchors of a phrase share: doc, digest, phrase_id, start.

    Intersected from the rarest list on, each further list by an equality of document, term and position.
    """
    place = anchors.groupBy("phrase_id").agg(F.array_sort(F.collect_list(F.struct("rank", "term", "at"))).alias("anchors"))
    first = place.withColumns({"term": F.col("anchors")[0]["term"], "shift": F.col("anchors")[0]["at"]})
    found = join_sized(index, first, ["term"], "inner", 100_000)
    found = found.select("doc", "digest", "phrase_id", "anchors", (F.col("at") - F.col("shift")).alias("start")).filter("start >= 0")
    for k in range(1, ANCHORS):
        wanted = F.get("anchors", F.lit(k))
        rows = found.withColumns({"term": wanted["term"], "pos": F.col("start") + wanted["at"]})
        post = index.select(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"), F.col("term").alias("_term"), F.col("at").alias("_at"))
        on = (
            F.col("doc").eqNullSafe(F.col("_doc"))
            & (F.col("digest") == F.col("_digest"))
            & (F.col("term") == F.col("_term"))
            & (F.col("pos") == F.col("_at"))
        )
        shared = rows.filter(F.col("term").isNotNull()).join(post.hint("merge"), on, "semi")
        found = shared.unionByName(rows.filter(F.col("term").isNull())).select("doc", "digest", "phrase_id", "anchors", "start")
    return found.drop("anchors").distinct()


def proximity_matches(index: DataFrame, anchors: DataFrame, within: int) -> DataFrame:
    """Documents where all anchors of an item lie within `within` words of its rarest: doc, digest, item.

    Positions are compared in cells of `within` words and their neighbours, by equality.
    """
    last = anchors.groupBy("item").agg(F.max("rank").alias("n_anchors"))
    near = join_sized(index, anchors.select("term", "item", "rank").join(last, "item"), ["term"], "inner", 100_000)
    cell = F.floor(F.col("at") / within)
    centres = near.filter("rank = 1").select("doc", "digest", "item", "n_anchors", F.col("at").alias("centre"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    others = near.filter("rank > 1").select(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"), F.col("item").alias("_item"), "rank", "at", cell.alias("_cell"))
    on = (
        F.col("doc").eqNullSafe(F.col("_doc"))
        & (F.col("digest") == F.col("_digest"))
        & (F.col("item") == F.col("_item"))
        & (F.col("cell") == F.col("_cell"))
    )
    met = centres.join(others, on).filter(F.abs(F.col("at") - F.col("centre")) <= within)
    full = met.groupBy("doc", "digest", "item", "centre", "n_anchors").agg(F.count_distinct("rank").alias("n")).filter("n = n_anchors - 1")
    alone = near.filter("n_anchors = 1").select("doc", "digest", "item")
    return full.select("doc", "digest", "item").unionByName(alone).distinct()


def covered(spans: Column) -> Column:
    """How many positions lie in the spans, structs of start and size sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + F.size(s["phrase"])).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["start"] + F.size(s["phrase"]) - F.greatest(a["end"], s["start"]))).alias("n"),
    )
    return F.aggregate(spans, zero, step)["n"]


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    words: int = 10,
    near_terms: int = 3,
    within: int = 20,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """For every row of `docs`: n_words, n_hit (words inside an occurrence of a phrase of an item),
    items (sorted ids, as strings, of the items with occurring phrases), near_items (sorted ids of
    the items whose `near_terms` rarest terms lie within `within` words of the rarest).

    A phrase is `words` consecutive words of an item, or all of a shorter one. A null or empty text
    has no words and no hits; so has an item, which then matches nothing. Items with a null id make
    hits but are not listed. Repeated rows each get their result, a null key is a key like others,
    and other columns are not read. Empty tables on either side give rows without hits or no rows.
    """
    words_of = keyed(docs, key, text)
    phrases = stored(item_phrases(items, words), "phrases")
    terms = phrases.select("phrase_id", F.posexplode("phrase").alias("at", "term"))
    item_terms = (
        items.select(F.col("item_id").cast("string").alias("item"), F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
        .na.drop()
        .withColumn("at", F.lit(0))
    )
    counts = stored(term_counts(words_of, terms.select("term").distinct()), "counts")
    anchors = stored(rarest(terms, counts, "phrase_id", ANCHORS).select("phrase_id", "term", "at", "rank"), "anchors")
    near_anchors = stored(rarest(item_terms, counts, "item", near_terms).select("item", "term", "rank"), "near")
    index = build_index(words_of, anchors.select("term").union(near_anchors.select("term")).distinct())

    starts = phrase_starts(index, anchors)
    with_words = join_sized(starts, phrases, ["phrase_id"], "inner", 100_000)
    candidates = stored(
        with_words.groupBy("doc", "digest").agg(F.array_sort(F.collect_list(F.struct("start", "phrase", "items"))).alias("spans")),
        "candidates",
    )
    keys = candidates.select("doc", "digest")
    few = keys.count() <= 200_000
    left = same_doc(words_of, F.broadcast(keys) if few else keys.hint("merge"), "semi").dropDuplicates(["doc", "digest"])
    checked = same_doc(left, candidates.hint("merge"), "inner").withColumn(
        "spans", F.filter("spans", lambda s: F.slice("w", s["start"] + 1, F.size(s["phrase"])) == s["phrase"])
    )
    hits = checked.select(
        "doc",
        "digest",
        covered(F.col("spans")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: s["items"])))).alias("items"),
    ).filter("n_hit > 0")
    near = proximity_matches(index, near_anchors, within).groupBy("doc", "digest").agg(F.array_sort(F.collect_set("item")).alias("near_items"))
    out = words_of.select("doc", "digest", F.size("w").alias("n_words"))
    out = same_doc(same_doc(out, hits, "left"), near, "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("doc").alias(key),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"),
        "digest",
    )


def without_benchmark(docs: DataFrame, items: DataFrame, words: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` in which no phrase of an item occurs; all columns. See `benchmark_hits`."""
    hit = benchmark_hits(docs, items, words, key=key, text=text).filter("n_hit > 0")
    names = [fresh(docs, n) for n in ("_doc", "_absent", "_hash")]
    code = lambda c: [F.coalesce(c.cast("string"), F.lit("")), c.isNull()]  # null equals null
    bad = stored(hit.select(*code(F.col(f"`{key}`")), "digest").toDF(*names).distinct(), "contaminated")
    wide = docs.withColumns(dict(zip(names, [*code(F.col(f"`{key}`")), F.xxhash64(F.col(f"`{text}`"))])))
    return narrowed(wide, bad, names, "anti").drop(*names)
