"""Text operators against brute force, with nulls, empty and long texts, ties, repeats and clashing names."""

import re
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from text_rows import DOCS
from tokenizers import Tokenizer

from seriesmill.llm import components, decontaminate, licenses, line_dedup, near_dedup, packing, quality, segments, shingles, substring_dedup, token_files, unigram, url_rules
from seriesmill.llm.common import scratch_dir

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def bag(rows):
    return Counter(map(tuple, rows))


def ids_of(texts):
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_quality(docs, no_docs):
    out, m = quality.measure_lines(docs)
    rows = out.select("doc_id", "text", f"{m}.*").collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        w = brute.words(r["text"])
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        left = brute.cleaned(r["text"] or "")
        assert r["kept"] == (left is not None)
        if left is not None:
            assert r["cleaned"] == left
    kept = quality.clean_documents(docs)
    assert kept.columns == docs.columns
    assert bag(kept.select("doc_id", "text").collect()) == bag((k, brute.cleaned(t or "")) for k, t in DOCS if brute.cleaned(t or "") is not None)
    assert quality.clean_documents(no_docs).count() == 0


LINES = {
    "The catalog in total has ten parts, and all of us share this view of them.": False,
    "We share this way of working with every team that has asked for it so far.": False,
    "Share this page": True,
    "LOG IN TO your account": True,
    "By signing in you agree to our Terms of Use and our Privacy Policy.": True,
    "Éshare this": False,
    "share this_one": False,
    "Copyright 2020 Example. All rights reserved.\r": True,
    "यह एक लंबा वाक्य है जिसमें दस से अधिक शब्द हैं और अंत में दंड है।": False,
    "Սա երկար նախադասություն է որը ունի տասից ավելի բառ և վերջում ունի իր կետը մեկ։": False,
    "one two three four five six seven eight nine ten eleven twelve": True,
    "": False,
}


def test_lines(spark):
    rows = spark.createDataFrame([(line,) for line in LINES], "line string")
    got = {r["line"]: r["bad"] for r in rows.withColumn("bad", quality.line_fails(F.col("line"), quality.split_words(F.col("line")), quality.LineRules())).collect()}
    assert got == LINES == {line: bool(brute.line_fails(line)) for line in LINES}


@pytest.mark.parametrize("rounds", [4, 0])
@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, k, rounds, monkeypatch):
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", rounds)
    got = near_dedup.near_duplicates(docs, shingle=k).select("doc_id", "n_shingles", "component_id").collect()
    want = [(key, len(brute.shingles(t, k)), c) for (key, t), c in zip(DOCS, brute.components(DOCS, k))]
    assert bag(got) == bag(want)
    left = near_dedup.without_near_duplicates(docs, shingle=k)
    assert left.columns == docs.columns
    assert bag(left.select("doc_id", "text").collect()) == bag(d for d, w in zip(DOCS, want) if d[0] is None or w[2] == d[0])


def test_near_duplicates_of_nothing(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert near_dedup.without_near_duplicates(no_docs).count() == 0


def test_star_with_an_unlike_centre(spark, monkeypatch):
    """All documents in one bucket: what the first star refutes, later rounds or pairs must find."""
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(6)] + [(10 + i, " ".join([f"y{i}"] + [f"z{j}" for j in range(39)])) for i in range(5)]
    rows += [(90 + i, " ".join(f"u{i}.{j}" for j in range(30))) for i in range(6)]
    want = {k: c for (k, _), c in zip(rows, brute.components(rows, 2))}
    monkeypatch.setattr(near_dedup, "sketch", one_bucket(near_dedup.sketch))
    for n in (0, 2, 4):
        monkeypatch.setattr(near_dedup, "STAR_ROUNDS", n)
        out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2)
        assert {r["doc_id"]: r["component_id"] for r in out.collect()} == want


def one_bucket(sketch):
    return lambda *a: sketch(*a).withColumn("bands", F.array(F.lit(1).cast("long")))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 105), (105, 102), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 105: 100, 102: 100, **{200 + i: 200 for i in range(50)}}


@pytest.mark.parametrize("hot", [2000, 1])
def test_repeated_windows(docs, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    got = substring_dedup.remove_repeats(docs, window=12, seed=3).collect()
    assert bag(got) == bag((k, *w) for (k, _), w in zip(DOCS, brute.without_windows(DOCS, 12)))


@pytest.mark.parametrize("hot", [150_000, 300])
def test_repeated_windows_of_null_keys_and_long_runs(spark, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "LONGEST", 64)
    shared = " ".join(f"w{i}" for i in range(20))
    rows = [(1, "a b c " * 700 + "end"), (2, "x " * 1000), (3, "b c a " * 50 + shared), (None, shared + " tail"), (None, "alone " + " ".join(f"v{i}" for i in range(30)))]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=12, seed=3).collect()
    assert bag(got) == bag((k, *w) for (k, _), w in zip(rows, brute.without_windows(rows, 12)))


def test_repeated_windows_of_nothing(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_benchmark(spark, docs, no_docs):
    items = [(1, "word3 follows another3 in passage9. word4 follows another4 in passage12 word5 follows"), (2, "SINGLE"), (3, "absent words only"), (4, None), (5, ""), (6, "quick brown fox"), (7, "the quick brown fox"), (None, "東京 タワー")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.benchmark_hits(docs, bench)
    named = [(i, t) for i, t in items]
    want = [(k, n, h, [x for x in found if x != "None"]) for (k, _), (n, h, found) in zip(DOCS, brute.benchmark_hits(DOCS, named))]
    assert bag((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect()) == bag((*w[:3], tuple(w[3])) for w in want)
    left = decontaminate.without_benchmark(docs, bench)
    assert left.columns == docs.columns
    assert bag(left.select("doc_id", "text").collect()) == bag(d for d, w in zip(DOCS, want) if not w[2])
    assert decontaminate.benchmark_hits(no_docs, bench).count() == 0
    nothing = bench.limit(0)
    assert all(r["n_hit"] == 0 for r in decontaminate.benchmark_hits(docs, nothing).collect())


def test_benchmark_tables_are_not_broadcast(spark, docs):
    """Files of postings and candidates are far smaller than their rows: a small file is no reason to send them to all."""
    items = [(1, "word3 follows another3 in passage9. word4 follows another4 in passage12 word5 follows"), (2, "SINGLE"), (3, "the quick brown fox")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    joins = lambda df: re.findall(r"(\w+Join) (.*)", df._jdf.queryExecution().sparkPlan().toString())
    got = decontaminate.benchmark_hits(docs, bench)
    assert [kind for kind, on in joins(got) if "_digest" in on and "_item" not in on and "Inner" in on] == ["SortMergeJoin"]
    want = [(k, n, h, tuple(found)) for (k, _), (n, h, found) in zip(DOCS, brute.benchmark_hits(DOCS, items))]
    assert bag((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect()) == bag(want)

    anchors = spark.createDataFrame([(7, "quick", 1, 1), (7, "brown", 2, 2), (8, "single", 0, 1)], "phrase_id long, term string, at int, rank int")
    starts = decontaminate.phrase_starts(decontaminate.build_index(decontaminate.keyed(docs), anchors.select("term")), anchors)
    assert [kind for kind, on in joins(starts) if "_at" in on] == ["SortMergeJoin"]
    assert bag(starts.select("doc", "phrase_id", "start").collect()) == bag(
        {(k, p, i - at) for k, t in DOCS for w in [brute.tokens(t)] for p, at, terms in ((7, 1, ["quick", "brown"]), (8, 0, ["single"])) for i in range(at, len(w)) if w[i : i + len(terms)] == terms}
    )


def test_url_rules(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/", "allow"), ("a.example.net", "/", "allow"), ("a.example.net", "/", "block"), ("org", "/fr/", "allow"), (None, "/", "block")]
    urls = [
        (1, "http://x.example.net/en/1"), (2, "https://EXAMPLE.net/fr/"), (3, "http://b.a.example.net/en/q?x#y"), (4, "http://badexample.net"), (5, None), (6, "no scheme"),
        (7, "ftp://y.org/fr/z#t"), (8, "http://org/fr/"), (9, "http://example.net?x=/en/"), (10, "://"), (11, "http://\x01example.net/en/"), (7, "ftp://y.org/fr/z#t"), (None, "http://net/"),
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("key", F.lit("clash"))

    def want(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = next((rest[:i] for i, c in enumerate(rest) if c in "/?#"), rest)
        tail = rest[len(host) :]
        path = next((tail[:i] for i, c in enumerate(tail) if c in "?#"), tail)
        host = host.translate(brute.UPPER)
        fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[3:] if fits else (None, "allow")))

    for n in (1, 5):
        got = url_rules.judge_urls(pages, spark.createDataFrame(rules, url_rules.RULE_SCHEMA), partitions=n)
        assert bag(got.collect()) == bag((k, *want(u)) for k, u in urls)
    assert url_rules.judge_urls(pages.limit(0), spark.createDataFrame(rules, url_rules.RULE_SCHEMA)).count() == 0
    assert {r["verdict"] for r in url_rules.judge_urls(pages, spark.createDataFrame([], url_rules.RULE_SCHEMA)).collect()} == {"allow"}


def test_licences(spark, docs, no_docs):
    texts = ["RELEASED under the MIT   license!", "x\nLicensed under CC BY-NC 4.0. More follows here", "nothing", None, "", licenses.TEMPLATES[1][1]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("w", F.lit(1)).withColumn("licence", F.lit(1))
    got = {r["doc_id"]: r for r in licenses.scan_licences(df, licenses.template_table(spark)).collect()}
    assert [got[i]["licences"] for i in range(6)] == ["MIT", "CC-BY-NC-4.0", None, None, None, "BSD"]
    assert got[0]["best_dice"] == 1.0 and got[2]["n_matches"] == 0
    assert licenses.scan_licences(docs, licenses.template_table(spark)).count() == len(DOCS)
    assert licenses.scan_licences(no_docs, licenses.template_table(spark)).count() == 0
    assert licenses.scan_licences(df, licenses.template_table(spark).limit(0)).filter("n_matches > 0").count() == 0


def test_packing_keeps_the_fuller_sequences():
    """At the end of a partition only ids of the emptiest sequences move: fewer than half of those still open, whole sequences aside."""
    rnd = np.random.default_rng(5)
    for n in (1, 7, 500, 2000):
        packer, placed, kept, out = packing.SumOfSquares(2048), 0, set(), []
        for doc, size in enumerate(rnd.integers(1, 1500, n)):
            placed += size
            whole = packer.place((doc, 0, np.full(size, doc), size), int(size))
            out += [whole] if whole else []
        open_ids = placed - 2048 * len(out)
        left = sorted((level for level, held in packer.open.items() for _ in held), reverse=True)
        out += packer.drain()
        sizes = [sum(len(p[2]) for p in pieces) for pieces in out]
        assert sum(sizes) == placed and all(s == 2048 or s & (s - 1) == 0 for s in sizes)
        assert sum(s < 2048 for s in sizes) <= 11
        ids = {}
        for pieces in out:
            for doc, start, part, total in pieces:
                assert len(part) and (part == doc).all()
                ids.setdefault(doc, []).append((start, start + len(part), total))
        for parts in ids.values():
            parts.sort()
            assert parts[0][0] == 0 and parts[-1][1] == parts[-1][2] and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert packer.moved == sum(2048 - level for level in left[: open_ids // 2048])
        assert packer.moved <= open_ids / 2


def test_packing(docs, no_docs):
    rows = packing.pack_documents(docs, BPE, capacity=64, with_ids=True).collect()
    sequences = {}
    for r in rows:
        assert r["length"] == len(r["ids"]) > 0 and r["ids_crc32"] == crc(r["ids"])
        sequences.setdefault(r["sequence_id"], []).append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        size = sum(r["length"] for r in pieces)
        assert [r["offset"] for r in pieces] == [sum(p["length"] for p in pieces[:i]) for i in range(len(pieces))]
        assert size == 64 or size & (size - 1) == 0
    by_doc = Counter()
    for r in rows:
        for i, x in enumerate(r["ids"]):
            by_doc[r["doc_id"], r["doc_tokens"], r["start"] + i, x] += 1
    want = Counter()
    for (key, _), ids in zip(DOCS, ids_of([t for _, t in DOCS])):
        for i, x in enumerate([*ids, 1]):
            want[key, len(ids) + 1, i, x] += 1
    assert by_doc == want
    assert packing.pack_documents(no_docs, BPE).count() == 0


def test_sum_of_squares_rule():
    rng = np.random.default_rng(1)
    packer = packing.SumOfSquares(32)
    for size in rng.integers(1, 32, 400).tolist():
        n = packer.levels.copy()
        changed = {}
        for level in range(0, 32 - size + 1):
            if level and not n[level]:
                continue
            after = n.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 32
            changed[level] = int((after[1:32] ** 2).sum())
        chosen = packer.best_level(size)
        assert changed[chosen] == min(changed.values())
        packer.place((0, 0, np.zeros(size), size), size)


def test_segments():
    import pyarrow as pa

    texts = [t for _, t in DOCS] + ["a  b", " lead", "trail ", "x  y", "one.two, three! four", "l'été d'or", "a\n b \n c", "don't they'll 's"]
    coder = segments.Encoder(BPE)
    for _ in range(2):
        ids, begins = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == ids_of(texts)
    small = segments.Encoder(BPE)
    small.cache.most = 5
    assert small.encode(pa.array(texts))[0].tolist() == ids.tolist()


def test_slices_are_right_for_string_kernels():
    import pyarrow as pa

    texts = [t for _, t in DOCS] * 3
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = list(segments.slices(batch, 2000))
    assert len(parts) > 5 and [t for p in parts for t in p.column(0).to_pylist()] == texts
    sets = [len(s) for p in parts for s in shingles.shingle_sets(p.column(0), 2)]
    assert sets == [len(brute.shingles(t, 2)) for t in texts]
    coder, want = segments.Encoder(BPE), segments.Encoder(BPE).encode(pa.array(texts))[0]
    assert np.concatenate([coder.encode(p.column(0))[0] for p in parts]).tolist() == want.tolist()


def test_token_files(spark, docs, no_docs):
    folder = scratch_dir(spark, "tokens")
    manifest = token_files.write_tokens(docs, folder, BPE, partitions=4)
    got = token_files.read_tokens(spark, manifest, docs.schema["doc_id"].dataType).orderBy("start").collect()
    want = {}
    for (key, text), ids in zip(DOCS, ids_of([t for _, t in DOCS])):
        want.setdefault(key, []).append((len(ids) + 1, crc([*ids, 2])))
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag((k, *v) for k, vs in want.items() for v in vs)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert sum(r["n_tokens"] for r in manifest.collect()) == at
    assert token_files.token_corpus(no_docs, BPE).count() == 0


def test_token_counts(docs, no_docs):
    import regex

    scores, pattern = brute.zipf(unigram.read_pieces(RANKS)), regex.compile(public_tokenizers.PATTERN)
    counts = {t: brute.viterbi(t.encode(), scores) for _, text in DOCS for t in set(pattern.findall(text or ""))}
    got = unigram.count_tokens(docs, RANKS).collect()
    assert bag(got) == bag((k, len(ts), sum(counts[t] for t in ts)) for k, text in DOCS for ts in [pattern.findall(text or "")])
    assert unigram.count_tokens(no_docs, RANKS).count() == 0


def test_trie_shares_and_forgets():
    scores = {b"a": -1.0, b"b": -1.5, b"ab": -2.0, b"ba": -3.0, b"aba": -2.9}
    for most in (1000, 4):
        trie = unigram.Trie(scores, most)
        for token in (b"aba", b"abab", b"", b"bbbb", b"abaaba"):
            assert trie.count_pieces(token) == brute.viterbi(token, scores)
    trie = unigram.Trie(scores)
    trie.count_pieces(b"abab"), trie.count_pieces(b"abaa")
    assert len(trie.best) == 6


def test_patience():
    assert line_dedup.patience(list("abcxdef"), list("abcydef")) == [(0, 0), (1, 1), (2, 2), (4, 4), (5, 5), (6, 6)]
    assert line_dedup.patience(list("xabcy"), list("zabcw")) == [(1, 1), (2, 2), (3, 3)]
    assert line_dedup.patience([], list("a")) == []
    assert line_dedup.ascending([5, 1, 2, 9, 3, 4]) == [1, 2, 4, 5]


def test_line_dedup(spark, no_docs):
    long = lambda i: f"This is line number {i} of a text that several documents share with each other."
    rows = [
        (1, "\n".join(long(i) for i in range(6))),
        (2, "Own start of the second.\n" + "\n".join(long(i) for i in range(2, 5)) + "\nOwn end."),
        (3, "\n".join(long(i) for i in (5, 4, 3))),
        (4, "\n".join(long(i) for i in range(6))),
        (5, "Short.\nOwn line."),
        (6, "Short.\nAnother line."),
        (7, "\n\n\n"),
    ]
    more = [(8, None), (None, rows[0][1]), (4, rows[3][1])]
    df = spark.createDataFrame(rows + more, "doc_id long, text string").withColumn("lines", F.lit(1)).withColumn("_removed", F.lit(2))
    out, removed = line_dedup.without_shared_lines(df)
    assert out.columns == [*df.columns, removed]
    got = bag(out.select("doc_id", "text").collect())
    left = brute.lines_removed(rows)
    assert left[4] == "" and left[5] == rows[4][1] and left[2] == "Own start of the second.\nOwn end."
    assert got == bag([*left.items(), (8, None), (None, rows[0][1]), (4, "")])
    assert line_dedup.without_shared_lines(no_docs)[0].count() == 0
