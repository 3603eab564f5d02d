"""Line-first cleaning: judge every line, remove those that fail, then judge what is left.

Rules of a line (only lines with a word are judged, the others stay):

* punctuation: more than `heading_words` words and no sentence mark anywhere;
* shouting: at least two runs of `!!`, one for every four words;
* symbols: more than a tenth of its characters are `#*$%&|<>{}=~^_`;
* navigation: at least three words are separators, one in every six or more;
* repetition: at least `heading_words` words, half of them equal to the word before;
* boilerplate: a line of at most 300 characters of which a third of the words or more belong to
  phrases below, as whole words ("log in to" is not in "catalog in total").

Everything is column expressions on one row, so a document never leaves its task, whatever its
source, and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import ascii_lower, computed, fresh, split_words

# Marks that end a sentence or a clause: Latin, East Asian, Indic, Armenian, Arabic, Ethiopic, Burmese, Khmer, Tibetan.
SENTENCE_MARK = r"[.!?:;…。！？．：；।॥։՞՜؟۔؛።፧፨။។།]"
LINE_SYMBOLS = r"[#*$%&|<>{}=~^_]"
SEPARATORS = ("|", "/", ">", "<", "»", "›", "·", "•", "-", "–", "—")
PHRASES = (
    "accept all cookies",
    "all rights reserved",
    "back to top",
    "click here to",
    "cookie policy",
    "cookie settings",
    "enable javascript",
    "follow us on",
    "forgot your password",
    "log in to",
    "lorem ipsum",
    "privacy policy",
    "share this",
    "sign up for",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "this site uses cookies",
)
# What may not stand beside a phrase.
WORD_CHAR = r"\p{L}\p{N}_"


@dataclass(frozen=True)
class LineRules:
    """`min_words` and `max_repeat_percent` are the base checks of a whole text; `max_lost_percent`
    is how much of the characters in words may go with the failed lines."""

    heading_words: int = 10
    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    max_lost_percent: int = 50


def line_fails(line: Column, words: Column, rules: LineRules) -> Column:
    n = F.size(words)
    marks = F.size(F.split(line, "!!+")) - 1
    symbols = F.length(line) - F.length(F.regexp_replace(line, LINE_SYMBOLS, ""))
    separators = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
    repeats = F.size(F.filter(words, lambda w, i: w.eqNullSafe(F.get(words, i - 1))))
    phrase, in_phrases = F.lit(False), F.lit(0)
    low = ascii_lower(line)
    for p in PHRASES:
        whole = low.contains(p) & low.rlike(f"(^|[^{WORD_CHAR}]){p}([^{WORD_CHAR}]|$)")
        phrase, in_phrases = phrase | low.contains(p), in_phrases + F.when(whole, len(p.split())).otherwise(0)
    return (n > 0) & (
        ((n > rules.heading_words) & ~line.rlike(SENTENCE_MARK))
        | (line.contains("!!") & (marks >= 2) & (marks * 4 >= n))
        | (symbols * 10 > F.length(line))
        | ((separators >= 3) & (separators * 6 >= n))
        | ((n >= rules.heading_words) & (repeats * 2 >= n))
        | ((F.length(line) <= 300) & phrase & (in_phrases * 3 >= n))
    )


def repeated_words(hashes: Column, window: int) -> Column:
    """Words covered by windows whose hash occurs twice or more; `hashes` has one per position."""

    def covered(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda e, k: e["h"].eqNullSafe(F.get(ordered, k - 1)["h"]) | e["h"].eqNullSafe(F.get(ordered, k + 1)["h"]),
        )
        starts = F.array_sort(F.transform(twice, lambda e: e["at"]))
        return F.transform(
            F.array(starts),
            lambda s: F.aggregate(
                F.transform(s, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(s, k + 1) - p, F.lit(window)))),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )[0]

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    found = F.transform(F.array(pairs), covered)[0]
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0))


def window_hashes(words: Column, window: int) -> list:
    """Steps from words to the 64-bit hash of every window: hashes of 1, 2, 4, ... words by doubling."""
    steps, size = [lambda c: F.transform(c, lambda w: F.xxhash64(w))], 1
    while size < window:
        step = min(size, window - size)
        steps.append(lambda c, s=step: F.transform(c, lambda h, i: F.xxhash64(h, F.get(c, i + s))))
        size += step
    steps.append(lambda c: F.slice(c, 1, F.greatest(F.size(c) - (window - 1), F.lit(0))))
    return steps


def measure_lines(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> tuple[DataFrame, str]:
    """`docs` with one more column, a struct of measures, and the name of that column.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), n_lines_removed,
    chars_lost (long), base_failed, kept (boolean), cleaned (string: the text without failed lines).
    A null text has no words: all measures are 0, base_failed is true, cleaned null. An empty text
    likewise, with cleaned empty. Rows are judged one by one: repeated rows all stay, an empty
    table gives an empty one, and other columns, whatever their names, pass unchanged. Equal
    windows are told by 64-bit hashes within one text.
    """
    tmp = {n: fresh(docs, f"_{n}") for n in ("lines", "split", "bad", "h", "measure")}
    col = {n: F.col(f"`{c}`") for n, c in tmp.items()}
    body = F.col(f"`{text}`")
    out = docs.withColumn(tmp["lines"], F.coalesce(F.split(body, "\n"), F.array().cast("array<string>")))
    out = out.withColumn(tmp["split"], F.transform(col["lines"], lambda line: split_words(line)))
    words = F.flatten(col["split"])
    out = out.withColumn(tmp["h"], words)
    for step in window_hashes(words, rules.window):
        out = out.withColumn(tmp["h"], step(col["h"]))
    out = out.withColumn(
        tmp["bad"],
        F.zip_with(col["lines"], col["split"], lambda line, ws: line_fails(line, ws, rules)),
    )
    n_words = F.aggregate(col["split"], F.lit(0), lambda t, ws: t + F.size(ws))
    chars = lambda ws: F.length(F.array_join(ws, ""))
    all_chars = F.aggregate(col["split"], F.lit(0), lambda t, ws: t + chars(ws))
    lost = F.aggregate(F.filter(col["split"], lambda ws, i: F.get(col["bad"], i)), F.lit(0), lambda t, ws: t + chars(ws))
    symbols = F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]", ""))
    with_words = F.filter(col["lines"], lambda line, i: F.size(F.get(col["split"], i)) > 0)
    dups = F.transform(F.array(with_words), lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))[0]
    cleaned = F.array_join(F.filter(col["lines"], lambda line, i: ~F.get(col["bad"], i)), "\n")
    removed = F.size(F.filter(col["bad"], lambda b: b))
    out = out.withColumn(
        tmp["measure"],
        F.struct(
            n_words.cast("long").alias("n_words"),
            all_chars.cast("long").alias("word_chars"),
            F.coalesce(symbols, F.lit(0)).cast("long").alias("n_symbols"),
            dups.cast("long").alias("n_dup_lines"),
            repeated_words(col["h"], rules.window).cast("long").alias("n_repeat_words"),
            removed.cast("long").alias("n_lines_removed"),
            lost.cast("long").alias("chars_lost"),
            F.when(body.isNotNull(), cleaned).alias("cleaned"),
        ),
    )
    m = lambda f: col["measure"][f]
    base = (m("n_words") < rules.min_words) | (m("n_repeat_words") * 100 > m("n_words") * rules.max_repeat_percent)
    too_much = m("chars_lost") * 100 > m("word_chars") * rules.max_lost_percent
    judged = col["measure"].withField("base_failed", base).withField("kept", ~base & ~too_much)
    last = fresh(out, "_judged")
    return computed(out.drop(tmp["lines"], tmp["split"], tmp["bad"], tmp["h"]), **{last: judged}).drop(tmp["measure"]), last


def clean_documents(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, without their failed lines; all columns of `docs`, in order.

    Nulls, empty tables, repeated rows and other columns: see `measure_lines`.
    """
    out, m = measure_lines(docs, text, rules)
    out = out.filter(F.col(f"`{m}`.kept")).withColumn(text, F.col(f"`{m}`.cleaned"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
