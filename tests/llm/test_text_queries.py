"""The registered text queries against their SQL or brute force, and the pipeline stage by stage."""

import hashlib
import zlib

import brute
import numpy as np
import oracle
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from seriesmill.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def token_ids(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in t.encode_batch([x or "" for _, x in rows], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), queries.SQL[name]) is None


def test_all_are_registered():
    assert [sum(n.startswith(f"op{k}_") for n in entry.queries()) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


def test_minhash_stars(spark, rows):
    got = {tuple(r) for r in queries.QUERIES["op10_minhash_stars"](spark, SF_DIR).collect()}
    assert got == {(k, len(brute.shingles(t, 2)), c, c == k) for (k, t), c in zip(rows, brute.components(rows, 2))}


def test_super_kmers(spark, rows):
    got = {tuple(r) for r in queries.QUERIES["op7_super_kmers"](spark, SF_DIR).collect()}
    assert got == {(k, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (k, _), (n, gone, kept) in zip(rows, brute.without_windows(rows, 35))}


def test_line_alignment(spark, rows):
    left = brute.lines_removed(rows)
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_line_alignment"](spark, SF_DIR).collect()}
    assert {k: r["kept_sha256"] for k, r in got.items()} == {k: brute.sha(t) for k, t in left.items()}
    assert all(got[k]["n_chars_removed"] == len(t) - len(left[k]) for k, t in rows)


def test_token_files(spark, rows, token_ids):
    at, want = 0, set()
    for (k, _), ids in zip(rows, token_ids):
        want.add((k, at, len(ids) + 1, crc([*ids, 2])))
        at += len(ids) + 1
    assert {tuple(r) for r in queries.QUERIES["op8_token_files"](spark, SF_DIR).collect()} == want


def test_packing(spark, rows, token_ids):
    got = queries.QUERIES["op5_sum_of_squares_packing"](spark, SF_DIR).collect()
    whole = {k: [*ids, 1] for (k, _), ids in zip(rows, token_ids)}
    covered = {k: [] for k in whole}
    for r in got:
        part = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == crc(part) and r["doc_tokens"] == len(whole[r["doc_id"]])
        covered[r["doc_id"]].extend(range(r["start"], r["start"] + r["length"]))
    assert all(sorted(c) == list(range(len(whole[k]))) for k, c in covered.items())


def test_pipeline_equals_brute_force(spark, rows):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    docs, want = spark.read.parquet(f"{SF_DIR}/documents.parquet"), dict(rows)
    columns = docs.columns
    steps = [
        lambda d: {k: c for k, t in d.items() if (c := brute.cleaned(t)) is not None},
        lambda d: {k: t for k, t in brute.lines_removed(list(d.items())).items() if brute.words(t)},
        lambda d: {k: d[k] for k, c in zip(d, brute.components(list(d.items()), 5)) if k == c},
        lambda d: {k: t for (k, t), (_, hit, _) in zip(d.items(), brute.benchmark_hits(list(d.items()), bench)) if not hit},
    ]
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        docs, want = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test"), step(want)
        assert docs.columns == columns, name
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == want, name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect()), name
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in pieces} == set(want)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k, text in want.items():
        own = sorted((r["start"], r["ids"]) for r in pieces if r["doc_id"] == k)
        assert [x for _, ids in own for x in ids] == [*t.encode(text, add_special_tokens=False).ids, 1]
