"""Ball codes, suffix arrays and token alignment against brute force."""

import hashlib
import random
from collections import Counter

import brute_vectors as brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from text_rows import DOCS

from seriesmill.llm import ball_codes, byte_dedup, queries, suffix_arrays, token_alignment

SF_DIR = "/root/testdata/sf0.001"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def bag(rows):
    return Counter(map(repr, rows))


def vectors(seed, n, dims):
    """Vectors with ties, repeated rows, nulls and values that are not numbers."""
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, rnd.uniform(-1, 1)]) for _ in range(dims)], rnd.choice(["x", "y", None])) for i in range(n)]
    rows += [(n, None, "x"), (n + 1, [], "x"), (n + 2, [None] * dims, None), (n + 3, [float("nan")] * dims, "y"), (n + 4, [float("inf")] + [0.0] * (dims - 1), "y")]
    rows += [(n + 5, [1.0] * (dims + parts), "x") for parts in (1, 4)] + [rows[2], rows[2], (None, [0.1] * dims, "x"), (n + 6, [1e30] * dims, "x")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "dims", "parts", "entries"), [(60, 8, 4, 8), (5, 4, 2, 256), (150, 6, 3, 20), (3, 4, 4, 4)])
def test_ball_codes(spark, n, dims, parts, entries):
    rows = vectors(n, n, dims)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("n", F.lit("clash")).withColumn("part", F.lit("clash")).withColumn("sums", F.lit("clash")).repartition(3)
    coded, books = ball_codes.ball_codes(df, parts, entries, rounds=3, carry=["label", "n", "sums"])
    want, want_books = brute.ball_codes([r[:2] for r in rows if r[1] != [1e30] * dims], parts, entries, 3)
    assert books == want_books
    assert bag((r["vec_id"], list(r["codes"]), r["error"]) for r in coded.collect()) == bag(want)
    assert {r["n"] for r in coded.collect()} <= {"clash"}


def test_ball_codes_of_nothing(spark):
    coded, books = ball_codes.ball_codes(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert coded.count() == 0 and books == []
    with pytest.raises(ValueError):
        ball_codes.ball_codes(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>"), parts=2)


def test_balls_equal_all_distances():
    rnd = np.random.default_rng(1)
    for most in (3, 1000, 1 << 27):
        entries = rnd.integers(-most, most, (40, 4))
        entries[7] = entries[3]  # a tie
        x = np.concatenate([rnd.integers(-most, most, (500, 4)), entries])
        code, error = ball_codes.nearest_of_all(x, entries)
        full = ((x[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(2)
        assert code.tolist() == full.argmin(1).tolist() and error.tolist() == full.min(1).tolist()
        for start in (np.zeros(len(x), np.int64), rnd.integers(0, 40, len(x)), code):
            again, d = ball_codes.Balls(entries).assign(x, start)
            assert again.tolist() == code.tolist() and d.tolist() == error.tolist()


def test_suffix_arrays_and_common_prefixes():
    rnd = random.Random(2)
    for bits in (21, 5):  # positions in one sort key, and the way for longer bodies
        suffix_arrays.BITS = bits
        for _ in range(150):
            s = bytes(rnd.choice(rnd.choice([b"a", b"ab", b"\0", bytes(range(256))])) for _ in range(rnd.randint(0, 200)))
            s += s[: rnd.randint(0, len(s))] if rnd.random() < 0.5 else b""
            body, size = np.frombuffer(s, np.uint8), rnd.choice([3, 20, 50])
            sa = suffix_arrays.suffix_array(body)
            assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
            shared = lambda a, b: next((k for k in range(size) if s[a + k : a + k + 1] != s[b + k : b + k + 1] or a + k >= len(s) or b + k >= len(s)), size)
            assert suffix_arrays.common_prefixes(body, sa, size, rnd.choice([1, 3, 8192])).tolist() == [0] * bool(s) + [shared(a, b) for a, b in zip(sa, sa[1:])]
    suffix_arrays.BITS = 21


def test_merged_runs():
    rnd = random.Random(3)
    for n in range(1, 7):
        runs = [sorted({bytes(rnd.choices(b"\0ab", k=5)) for _ in range(rnd.randint(0, 40))}) for _ in range(n)]
        values = [np.array([rnd.randint(0, 99) for _ in r], np.int64) for r in runs]
        least = {}
        for r, v in zip(runs, values):
            for k, x in zip(r, v.tolist()):
                least[k] = min(x, least.get(k, x))
        got = suffix_arrays.merged_least([(np.frombuffer(b"".join(r), "S5"), v) for r, v in zip(runs, values)])
        assert [g.tolist() for g in got] == [[least[k] for k in r] for r in runs]


PASSAGE = "This passage of more than fifty bytes stands in several texts, word for word, naïvely copied."
BYTES = [
    *DOCS, (50, "Before. " + PASSAGE + " After one."), (51, "ahead " + PASSAGE), (51, PASSAGE), (52, PASSAGE + PASSAGE), (53, PASSAGE[:49]), (54, PASSAGE[3:53]),
    (55, "x" * 49), (56, "x" * 50), (57, "x" * 51), (58, "x" * 400 + PASSAGE), (-3, "y" + PASSAGE[10:70]), (60, "é" * 40), (61, "z" + "é" * 40), (62, PASSAGE[:60] + "|" + PASSAGE[20:]),
]


@pytest.mark.parametrize("hot", [20_000, 3, 0])
def test_bytes_of_earlier_documents(spark, monkeypatch, hot):
    monkeypatch.setattr(byte_dedup, "SHARD_BYTES", 4000)
    df = spark.createDataFrame(BYTES, "doc_id long, text string").repartition(4).withColumn("doc", F.lit("clash")).withColumn("block", F.lit("clash"))
    got = byte_dedup.remove_earlier_bytes(df, hot=hot).collect()
    assert bag(map(tuple, got)) == bag(brute.without_earlier_bytes(BYTES))


def test_bytes_of_a_very_long_text(spark):
    """A long text with a short period, one with a passage far inside, and many copies under one key."""
    rows = [(1, "ab" * 400_000), (2, "q" + "ab" * 60), (3, "".join(f"{i} " for i in range(120_000)) + PASSAGE), (4, PASSAGE)] + [(5, "c." + PASSAGE)] * 200
    got = byte_dedup.remove_earlier_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag((r["doc_id"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got if r["doc_id"] != 3) == bag(
        [(1, 0, 0, rows[0][1].encode()), (2, 120, 1, b"q"), (4, len(PASSAGE.encode()), 1, b"")] + [(5, len(PASSAGE.encode()), 1, b"c.")] * 200
    )


def test_bytes_of_nothing(no_docs):
    assert byte_dedup.remove_earlier_bytes(no_docs).count() == 0


ODD = [
    (100 + i, t)
    for i, t in enumerate(
        [" lead", " ", "  two  spaces", "a  b", "▁under", "x ▁y", "<s> a </s> <0x41> <|endoftext|>", "tail ", "\n\nx\n y", " nb sp", "a　b c", "emoji 👩‍👩‍👧 ok", "\tx", "é ö", "\x00a b", "a ́b"]
    )
]


def scored(docs):
    documents, pairs = token_alignment.align_documents(docs, BPE, PIECES)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return token_alignment.score_links(documents.withColumn("sha", digest).drop("groups"), pairs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha")


def test_token_alignment(spark, no_docs):
    rows = DOCS + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("groups", F.lit("clash")).withColumn("block", F.lit("clash"))
    assert bag(map(tuple, scored(df).collect())) == bag(brute.aligned(rows, BPE, PIECES))
    assert scored(no_docs).count() == 0


def test_gallop():
    rnd = np.random.default_rng(4)
    for _ in range(100):
        ends = np.cumsum(rnd.integers(1, 5, rnd.integers(1, 60)))
        targets = np.sort(rnd.integers(1, ends[-1] + 1, 20))
        exact = np.searchsorted(ends, targets)
        begins = np.maximum(exact - rnd.integers(0, 40, 20), 0)
        assert token_alignment.gallop(targets, ends, begins).tolist() == exact.tolist()


@pytest.fixture(scope="module")
def table_rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def test_registered_alignment(spark, table_rows):
    assert bag(map(tuple, queries.QUERIES["op12_token_alignment"](spark, SF_DIR).collect())) == bag(brute.aligned(table_rows, BPE, PIECES))


def test_registered_suffix_arrays(spark, table_rows):
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute.without_earlier_bytes(table_rows)]
    assert bag(map(tuple, queries.QUERIES["op13_suffix_arrays"](spark, SF_DIR).collect())) == bag(want)
