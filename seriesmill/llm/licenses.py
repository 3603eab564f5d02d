"""Licence notices found by the Dice coefficient over word bigrams.

A text is compared as a whole, and so are its paragraphs, lines and sentences, since a notice may
be any of these. Text is normalised to lower-case words without punctuation. With `a` and `b`
distinct bigrams, Dice is at most 2 min(a, b) / (a + b), so a unit can only reach `least` with
templates of b from a * least / (2 - least) to a * (2 - least) / least bigrams. The join goes over
the number of bigrams, and no other pair is looked at.

A notice wrapped over lines or inside a longer sentence is none of these units. For it, windows of
as many words as the template has are compared, over the words of the whole text: those that begin
with a bigram of the template and have as many of its bigrams as any match needs. A window counts
where no unit of the key has the licence.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.llm.common import NON_TOKEN_RUN, ascii_lower, computed, split_words
from seriesmill.operators.joins import join_sized
from seriesmill.session import small_table

# One-sentence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Texts and standard headers as their licences word them: id, file in `licence_texts`, where it begins and ends.
PARTS = (
    ("Apache-2.0-file-notice", "Apache-2.0-text", "Licensed under the Apache License, Version 2.0 (the", "compliance with the License."),
    ("Apache-2.0-header", "Apache-2.0-text", "Licensed under the Apache License, Version 2.0 (the", "limitations under the License."),
    ("Apache-2.0-text", "Apache-2.0-text", "Apache License", "END OF TERMS AND CONDITIONS"),
    ("BSD-text", "BSD-3-Clause-text", "Redistribution and use", "SUCH DAMAGE."),
    ("GPL-3.0-header", "GPL-3.0-text", "This program is free software: you can redistribute", "gnu.org/licenses/>."),
    ("GPL-3.0-text", "GPL-3.0-text", "GNU GENERAL PUBLIC LICENSE", "END OF TERMS AND CONDITIONS"),
    ("MIT-full", "MIT-full", "Permission is hereby granted", "DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0-header", "MPL-2.0-text", "This Source Code Form is subject to the terms of the Mozilla", "MPL/2.0/."),
    ("MPL-2.0-text", "MPL-2.0-text", "Mozilla Public License", "Exhibit A - Source Code Form License Notice"),
    ("Unlicense-text", "Unlicense-text", "This is free and unencumbered", "OTHER DEALINGS IN THE SOFTWARE."),
)
LEAST = 0.8
# Templates of more bigrams are not ruled out by telling words, as too many would be needed.
LONG = 400


def licence_texts() -> list[tuple[str, str]]:
    """The templates of PARTS, read on the driver."""
    out = []
    for licence, file, begin, end in PARTS:
        text = " ".join((Path(__file__).parent / "licence_texts" / f"{file}.txt").read_text().split())
        at = text.index(begin)
        out.append((licence, text[at : text.index(end, at) + len(end)]))
    return out


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), NON_TOKEN_RUN)


def placed_bigrams(words: Column) -> Column:
    """Word bigrams as hashes, one for each position. `words` must be a computed column, as each pair looks into it."""
    firsts = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.transform(firsts, lambda x, i: F.xxhash64(x, F.get(words, i + 1)))


def bigrams(words: Column) -> Column:
    """Distinct word bigrams as hashes. `words` must be a computed column."""
    return F.array_distinct(placed_bigrams(words))


def units(text: Column) -> Column:
    """The whole text, its paragraphs, lines and sentences, each once; none for null."""
    sentences = F.split(F.regexp_replace(text, r"([.!?])[\x20\x09-\x0D]+", "$1\n"), "\n")
    return F.array_distinct(F.concat(F.array(text), F.split(text, r"\n[\x20\x09]*\n"), F.split(text, "\n"), sentences))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """The given templates, or the notices, headers and texts of this module. Their ids must differ."""
    schema = T.StructType([T.StructField("licence", T.StringType()), T.StructField("text", T.StringType())])
    return small_table(spark, [*TEMPLATES, *licence_texts()] if templates is None else list(templates), schema)


def may_match(templates: DataFrame, least: float, words: Column, most: int = 10_000) -> Column | None:
    """What is true of the words of every text with a unit that reaches `least`, or None if the templates are too many.

    Such a unit has at least b * least / (2 - least) of a template's b bigrams, so of any set of one
    bigram more than it may lack it has one, and both its words. The bigrams with the longest words
    are taken, since long words are rare. For a template of more than LONG bigrams the number of
    different words is tested: those that so many bigrams begin with, at least.
    """
    rows = templates.select(words_of(F.col("text")).alias("w")).limit(most + 1).collect()
    telling, tests = set(), []
    for (w,) in rows:
        pairs = sorted(set(zip(w, w[1:])), key=lambda p: (-max(map(len, p)), p))
        need = math.ceil(len(pairs) * least / (2 - least) - 1e-9)
        if len(pairs) > LONG:
            begun, n, left = Counter(p[0] for p in pairs), 0, need
            for _, count in begun.most_common():
                n, left = n + (left > 0), left - count
            tests.append((F.size(words) > need) & (F.size(F.array_intersect(words, F.array(*map(F.lit, sorted(begun))))) >= n))
        else:
            telling.update(max(p, key=len) for p in pairs[: len(pairs) - need + 1])
    if len(rows) > most or not len(telling) + len(tests) or len(telling) > most:
        return None
    test = F.arrays_overlap(words, F.array(*map(F.lit, sorted(telling)))) if telling else F.lit(False)
    for other in tests:
        test = test | other
    return test


def window_matches(rows: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """_key, _text, licence and dice of the best window of every row and template that reaches `least`.

    `rows` has _key and w, `known` licence, of_licence and span (its words less one).
    """
    placed = computed(rows, placed=placed_bigrams(F.col("w")))
    need = F.ceil(F.size("of_licence") * F.lit(least / (2 - least)) - 1e-9).cast("int")
    both = placed.join(F.broadcast(known.withColumn("need", need)), F.size(F.array_intersect("placed", "of_licence")) >= F.col("need"))
    hits = F.filter(F.transform("placed", lambda h, i: F.when(F.array_contains("of_licence", h), i)), lambda i: i.isNotNull())
    both = computed(both, hits=hits)
    starts = F.filter("hits", lambda p, k: F.get("hits", k + F.col("need") - 1) - p < F.col("span"))
    both = computed(both, starts=starts)

    def dice(p: Column) -> Column:
        own = F.array_distinct(F.slice("placed", p + 1, F.col("span")))
        return F.lit(2.0) * F.size(F.array_intersect(own, F.col("of_licence"))) / (F.size(own) + F.size("of_licence"))

    both = computed(both, best=F.array_max(F.transform("starts", lambda p: F.struct(dice(p).alias("dice"), (-p).alias("at")))))
    text = F.array_join(F.slice("w", F.lit(1) - F.col("best.at"), F.col("span") + 1), " ")
    return both.filter(F.col("best.dice") >= F.lit(least - 1e-9)).select("_key", text.alias("_text"), "licence", F.col("best.dice").alias("dice"))


def licence_matches(docs: DataFrame, templates: DataFrame, least: float = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for every unit and template whose Dice reaches `least`, and one for the best window
    of a text and template: key, unit, licence, dice, in_window.

    Units or templates of fewer than two words have no bigrams and match nothing; nor does null.
    Templates are counted; beyond what may be broadcast they are shuffled.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    known = computed(templates.select("licence", "text").na.drop(), w=words_of(F.col("text")))
    known = computed(known, of_licence=bigrams(F.col("w"))).select("licence", "of_licence", (F.size("w") - 1).alias("span")).filter(F.size("of_licence") > 0)
    low = lambda n: F.ceil(n * F.lit(least / (2 - least)) - 1e-9)
    high = lambda n: F.floor(n * F.lit((2 - least) / least) + 1e-9)
    sizes = known.select("licence", F.explode(F.sequence(low(F.size("of_licence")), high(F.size("of_licence")))).alias("n"))
    bounds = known.agg(F.min(low(F.size("of_licence"))), F.max(high(F.size("of_licence")))).first()
    least_n, most_n = bounds[0] or math.inf, bounds[1] or 0
    if most_n == 0:
        least_n = 1
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    rows = computed(rows, w=words_of(F.col("_text")))
    test = may_match(templates, least, F.col("w"))
    if test is not None:
        rows = rows.filter(test)
    each = rows.select("_key", F.explode(units(F.col("_text"))).alias("_text"))
    worded = computed(each, w=words_of(F.col("_text"))).filter(F.size("w") > F.lit(int(least_n)))
    found = computed(worded, of_unit=bigrams(F.col("w"))).drop("w").withColumn("n", F.size("of_unit").cast("long"))
    found = found.filter((F.col("n") >= int(least_n)) & (F.col("n") <= int(most_n)))
    both = join_sized(join_sized(found, sizes, ["n"], "inner"), known.drop("span"), ["licence"], "inner")
    common = F.size(F.array_intersect("of_unit", "of_licence"))
    both = both.withColumn("dice", F.lit(2.0) * common / (F.size("of_unit") + F.size("of_licence")))
    of_units = both.filter(F.col("dice") >= F.lit(least - 1e-9)).select("_key", "_text", "licence", "dice", F.lit(False).alias("in_window"))
    all_found = of_units.unionByName(window_matches(rows.select("_key", "w"), known, least).withColumn("in_window", F.lit(True)))
    return all_found.select(F.col("_key").alias(key), F.col("_text").alias("unit"), "licence", "dice", "in_window")


def scan_licences(docs: DataFrame, templates: DataFrame, least: float = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of `docs` with its licences (ids, sorted, comma-joined), the best one with its
    Dice rounded to four digits (ties: the smaller id), and the number of matches: of units, or
    of windows for a licence that no unit has.

    Without a match the licences are null and the number 0; so for null and empty texts. Rows with
    one key share their matches and each stay; null keys count as one key. Other columns are not
    read, so their names may clash. An empty table gives an empty one.
    """
    found = licence_matches(docs, templates, least, key, text)
    count = lambda windows: F.count(F.when(F.col("in_window") == windows, True))
    most = lambda windows: F.max(F.when(F.col("in_window") == windows, F.col("dice")))
    each = found.groupBy(F.col(f"`{key}`").alias("_key"), "licence").agg(
        F.coalesce(most(False), most(True)).alias("dice"), F.when(count(False) > 0, count(False)).otherwise(count(True)).alias("n")
    )
    best = F.struct((-F.round("dice", 4)).alias("d"), F.col("licence").alias("l"))
    per_key = each.groupBy("_key").agg(
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"), F.min(best).alias("best"), F.sum("n").alias("n_matches")
    )
    keys = docs.select(F.col(f"`{key}`").alias("_id"))
    return keys.join(per_key, F.col("_id").eqNullSafe(F.col("_key")), "left").select(
        F.col("_id").alias(key),
        "licences",
        F.col("best.l").alias("best_licence"),
        (-F.col("best.d")).alias("best_dice"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
    )
