"""The registered queries of the text operators, and their SQL where DuckDB can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import ball_codes, byte_dedup, decontaminate, licenses, line_dedup, near_dedup, packing, quality, substring_dedup, token_alignment, token_files, unigram, url_rules
from seriesmill.llm.common import narrow_join, table, tokenizer_file
from seriesmill.session import small_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


LINE_FIRST_SQL = f"""
WITH lines AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents
), words AS (
  SELECT *, list_transform(ls, lambda x: regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS lw FROM lines
), judged AS (
  SELECT *, list_transform(range(1, len(ls) + 1), lambda i: len(lw[i]) > 0 AND (
      (len(lw[i]) > 10 AND NOT regexp_matches(ls[i], '{quality.SENTENCE_MARK}'))
      OR (len(regexp_extract_all(ls[i], '!!+')) >= 2 AND len(regexp_extract_all(ls[i], '!!+')) * 4 >= len(lw[i]))
      OR (length(ls[i]) - length(regexp_replace(ls[i], '[#*$%&|<>{{}}=~^_]', '', 'g'))) * 10 > length(ls[i])
      OR (len(list_filter(lw[i], lambda w: w IN ({quoted(quality.SEPARATORS)}))) >= 3
          AND len(list_filter(lw[i], lambda w: w IN ({quoted(quality.SEPARATORS)}))) * 6 >= len(lw[i]))
      OR (len(lw[i]) >= 10 AND len(list_filter(range(2, len(lw[i]) + 1), lambda k: lw[i][k] = lw[i][k - 1])) * 2 >= len(lw[i]))
      OR (length(ls[i]) <= 300 AND list_sum(list_transform(list_filter([{quoted(quality.PHRASES)}],
          lambda p: contains(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p)),
          lambda p: CASE WHEN regexp_matches(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '(^|[^{quality.WORD_CHAR}])' || p || '([^{quality.WORD_CHAR}]|$)') THEN len(string_split(p, ' ')) ELSE 0 END)) * 3 >= len(lw[i]))
    )) AS bad, flatten(lw) AS ws FROM words
), starts AS (
  SELECT doc_id, i, hash(ws[i:i + 7]) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM judged)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, h) AS n FROM starts) WHERE n > 1
), repeated AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
    (len(list_filter(range(1, len(ls) + 1), lambda i: len(lw[i]) > 0))
      - len(list_distinct(list_transform(list_filter(range(1, len(ls) + 1), lambda i: len(lw[i]) > 0), lambda i: ls[i]))))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(bad, lambda b: b))::BIGINT AS n_lines_removed,
    coalesce(list_sum(list_transform(range(1, len(ls) + 1),
      lambda i: CASE WHEN bad[i] THEN length(array_to_string(lw[i], '')) ELSE 0 END)), 0)::BIGINT AS chars_lost
  FROM judged LEFT JOIN repeated USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND chars_lost * 100 <= word_chars * 50 AS kept
FROM measured
"""


@query("op4_line_first_cleaning", LINE_FIRST_SQL)
def line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, m = quality.measure_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", f"{m}.*").drop("cleaned")


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

URL_RULES_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
parts AS (
  SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest
), judged AS (
  SELECT page_id, coalesce(translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(substr(r, length(h) + 1), '^[^?#]*'), '') AS path FROM parts
), fits AS (
  SELECT j.*, u.host || u.path AS rule, u.verdict FROM judged j LEFT JOIN rules u
  ON (j.host = u.host OR ends_with(j.host, '.' || u.host)) AND starts_with(j.path, u.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""


@query("op3_url_rules", URL_RULES_SQL)
def url_rules_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = small_table(spark, URL_RULES, url_rules.RULE_SCHEMA)
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


LICENCE_SQL = f"""
WITH raw AS (
  SELECT doc_id, unnest(list_distinct(list_concat([text], string_split_regex(text, '\n[\x20\x09]*\n'), string_split(text, chr(10)),
    string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\\1' || chr(10), 'g'), chr(10))))) AS unit FROM documents WHERE text IS NOT NULL
), texts AS (
  SELECT 'u' AS kind, row_number() OVER () AS id, doc_id, NULL AS licence, unit AS t FROM raw
  UNION ALL
  SELECT 'l', 0, NULL, licence, t FROM (VALUES {", ".join("(" + quoted(t) + ")" for t in licenses.TEMPLATES)}) v(licence, t)
), worded AS (
  SELECT *, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), paired AS (
  SELECT kind, id, doc_id, licence, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM worded WHERE len(w) > 1
), scored AS (
  SELECT u.doc_id, l.licence, 2.0 * len(list_intersect(u.b, l.b)) / (len(u.b) + len(l.b)) AS dice
  FROM paired u JOIN paired l ON u.kind = 'u' AND l.kind = 'l' AND len(u.b) BETWEEN len(l.b) * 0.6 AND len(l.b) * 1.6
), per_doc AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, min((-round(dice, 4), licence)) AS best, count(*) AS n
  FROM scored WHERE dice >= 0.8 - 1e-9 GROUP BY doc_id
)
SELECT d.doc_id, licences, best[2] AS best_licence, -best[1] AS best_dice, coalesce(n, 0)::BIGINT AS n_matches
FROM documents d LEFT JOIN per_doc USING (doc_id)
"""


@query("op9_licence_scan", LICENCE_SQL)
def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(table(spark, sf_dir, "documents"), licenses.template_table(spark))


BENCHMARK_SQL = """
WITH low AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), worded AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM low
), phrases AS (
  SELECT DISTINCT id AS item, w[i:i + 9] AS p FROM (
    SELECT id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM worded WHERE kind = 'b' AND len(w) > 0)
), starts AS (
  SELECT id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM worded WHERE kind = 'd'
), lengths AS (SELECT DISTINCT len(p) AS k FROM phrases
), grams AS (
  SELECT id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: {'i': i, 'p': w[i:i + k - 1]})) AS g
  FROM worded, lengths WHERE kind = 'd' AND len(w) >= k
), found AS (
  SELECT id, g.i AS i, k, item FROM grams JOIN phrases ON p = g.p
), hit AS (
  SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS place FROM found) GROUP BY id
), listed AS (
  SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS items FROM found GROUP BY id
), counts AS (
  SELECT t, count(*) AS n FROM (SELECT unnest(w) AS t FROM worded WHERE kind = 'd') GROUP BY t
), item_terms AS (
  SELECT DISTINCT id AS item, unnest(w) AS t FROM worded WHERE kind = 'b'
), ranked AS (
  SELECT item, t, row_number() OVER (PARTITION BY item ORDER BY n, t) AS r, min(coalesce(n, 0)) OVER (PARTITION BY item) AS least
  FROM item_terms LEFT JOIN counts USING (t)
), near_terms AS (
  SELECT item, t, r, max(r) OVER (PARTITION BY item) AS last FROM ranked WHERE r <= 3 AND least > 0
), places AS (
  SELECT s.id, s.i, item, r, last FROM starts s JOIN near_terms USING (t)
), near AS (
  SELECT id, count(DISTINCT item) AS n_near FROM (
    SELECT c.id, c.item, c.i FROM places c LEFT JOIN places o ON o.id = c.id AND o.item = c.item AND o.r > 1 AND abs(o.i - c.i) <= 20
    WHERE c.r = 1 GROUP BY c.id, c.item, c.i, c.last HAVING count(DISTINCT o.r) = c.last - 1) GROUP BY id
)
SELECT w.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM worded w LEFT JOIN hit ON w.id = hit.id LEFT JOIN listed ON w.id = listed.id LEFT JOIN near ON w.id = near.id WHERE kind = 'd'
"""


@query("op2_benchmark_index", BENCHMARK_SQL)
def benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"),
    )


@query("op5_sum_of_squares_packing")
def sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op6_trie_token_counts")
def trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


@query("op8_token_files")
def token_files_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_corpus(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


MINHASH_SQL = """
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT rid, doc_id, CASE WHEN len(w) < 2 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w), 2))) AS i FROM worded WHERE len(w) > 0)
), sizes AS (SELECT rid, doc_id, count(*) AS n FROM shingles GROUP BY rid, doc_id
), common AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid < b.rid GROUP BY 1, 2
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS node, a AS other FROM both_ways UNION SELECT node, b FROM reach JOIN both_ways ON other = a
), named AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM worded w LEFT JOIN sizes s ON s.rid = w.rid LEFT JOIN named ON node = w.doc_id
"""


@query("op10_minhash_stars", MINHASH_SQL)
def minhash_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2).drop("text_hash")


@query("op1_line_alignment")
def line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("before"))
    out, removed = line_dedup.without_shared_lines(docs)
    return out.select(
        "doc_id",
        F.coalesce(F.size(F.split("before", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(removed), F.lit(0)).cast("long").alias("n_removed"),
        (F.length(F.coalesce("before", F.lit(""))) - F.length(F.coalesce("text", F.lit("")))).cast("long").alias("n_chars_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


SUPER_KMERS_SQL = """
WITH worded AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), starts AS (
  SELECT rid, i, md5_number(array_to_string(w[i:i + 34], ' ')) AS p FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM worded WHERE len(w) >= 35)
), hits AS (
  SELECT rid, i FROM starts JOIN (SELECT p FROM starts GROUP BY p HAVING count(*) > 1) USING (p)
), gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM hits
), places AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM worded
), kept AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS k, count(*) AS n FROM places ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM worded LEFT JOIN kept USING (rid)
"""


@query("op7_super_kmers", SUPER_KMERS_SQL)
def super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def ball_codes_sql(entries: int = 256, rounds: int = 4, parts: int = 4) -> str:
    """Every round in full: distances to all entries, then the floor of the means."""
    steps = [
        f"""WITH vecs AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM vecs, range({parts}) r(p)
), book0 AS MATERIALIZED (
  SELECT p, k, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k FROM cut) WHERE k < {entries}
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT vec_id, cut.p, min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), k)) AS best
  FROM cut JOIN book{r} ON cut.p = book{r}.p GROUP BY vec_id, cut.p
)""")
        if r < rounds:
            steps.append(f"""mean{r} AS (
  SELECT p, k, list(m ORDER BY i) AS c FROM (
    SELECT p, k, i, floor(sum(y) / count(*)) AS m FROM (
      SELECT p, best[2] AS k, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM near{r} JOIN cut USING (vec_id, p)) GROUP BY p, k, i) GROUP BY p, k
), book{r + 1} AS MATERIALIZED (
  SELECT p, k, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m USING (p, k)
)""")
    return ", ".join(steps) + f""", coded AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM near{rounds} GROUP BY vec_id
), flat AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT), ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book{rounds}
)
SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded c JOIN vecs USING (vec_id), flat"""


@query("op11_ball_k_means", ball_codes_sql())
def ball_k_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = ball_codes.ball_codes(table(spark, sf_dir, "embeddings"), carry=["label"])
    digest = hashlib.sha256(",".join(str(y) for book in books for entry in book for y in entry).encode()).hexdigest()
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return narrow_join(coded, errors, "label").select(
        "vec_id",
        F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


SUFFIX_ARRAYS_SQL = """
WITH bytes AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT rid, doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS p FROM (SELECT *, unnest(range(0, length(h) // 2 - 49)) AS i FROM bytes WHERE length(h) >= 100)
), hits AS (
  SELECT rid, i FROM starts JOIN (SELECT p, min(doc_id) AS first FROM starts GROUP BY p) USING (p) WHERE first < doc_id
), runs AS (
  SELECT rid, min(i) AS a, max(i) + 50 AS b FROM (
    SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM (
      SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hits)) GROUP BY rid, run
), between_runs AS (
  SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM runs
), pieces AS (
  SELECT rid, count(*) AS n, sum(b - a) AS gone, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS k
  FROM between_runs JOIN bytes USING (rid) GROUP BY rid
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN pieces USING (rid)
"""


@query("op13_suffix_arrays", SUFFIX_ARRAYS_SQL)
def suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_dedup.remove_earlier_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_token_alignment")
def token_alignment_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, pairs = token_alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    scored = token_alignment.score_links(documents.withColumn("groups_sha256", digest).drop("groups"), pairs)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
