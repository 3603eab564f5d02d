"""Cases that a cap, a short template list or too few units would miss."""

import random

import numpy as np

from seriesmill.llm import licenses, line_dedup


def left_texts(spark, rows):
    out, _ = line_dedup.without_shared_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    return dict(out.select("doc_id", "text").collect())


def test_common_long_line_beside_a_rarer_short_one(spark):
    """A long line of 30 documents goes although each later one also shares a short line with fewer."""
    long = "This long line stands in thirty documents and is removed from all but the first."
    rows = [(i, f"Short {i}.") for i in range(30)] + [(100 + i, f"{long}\nOwn line {i}.\nShort {i}.") for i in range(30)]
    got = left_texts(spark, rows)
    assert got == {k: t if k <= 100 else t.split("\n", 1)[1] for k, t in rows}


def test_block_of_short_lines_known_from_different_documents(spark):
    """Each line comes earlier by itself, each two as well; only document 5 has the whole block."""
    a, b, c = "First short line of some words", "Second short line", "Third short line of words"
    rows = [(0, f"{a}\n{b}\nx"), (1, f"{b}\n{c}\ny"), (2, f"{c}\nz"), (5, f"u\n{a}\n{b}\n{c}\nv"), (6, f"p\n{a}\n{b}\n{c}\nq")]
    got = left_texts(spark, rows)
    assert got == {**dict(rows), 6: "p\nq"}


def test_passage_that_stands_twice(spark):
    """Without a line that is unique on both sides, one copy is aligned all the same."""
    long = "This passage stands twice in the earlier document and once in the later one."
    rows = [(1, f"one\n{long}\ntwo\n{long}\nthree"), (2, f"four\n{long}\nfive"), (3, f"six\n{long}\nseven\n{long}\neight")]
    got = left_texts(spark, rows)
    assert got[1] == rows[0][1] and got[2] == "four\nfive" and got[3] == "six\nseven\neight"


def test_heaviest_block_and_runs():
    """Against all pairs of places."""
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ([rnd.choice(["aa", "b", "ccc", ""]) for _ in range(rnd.randint(0, 9))] for _ in range(2))
        i, j, n, chars = line_dedup.heaviest_block(a, b, len)
        equal = [(i, j, n) for i in range(len(a)) for j in range(len(b)) for n in range(1, len(a) - i + 1) if a[i : i + n] == b[j : j + n]]
        assert a[i : i + n] == b[j : j + n] and chars == max((sum(map(len, a[i : i + n])) for i, _, n in equal), default=0)
        sizes = [rnd.choice([0, 10, 25, 60, 70]) for _ in range(rnd.randint(1, 9))]
        at, run = line_dedup.runs_of_lines(np.array(sizes, np.int64), np.array(sizes, np.int32), np.array([0, len(sizes)]), 60)
        ahead = [(i, next((sizes[i:j] for j in range(i + 1, len(sizes) + 1) if sum(sizes[i:j]) >= 60), None)) for i, s in enumerate(sizes) if s]
        behind = [(i, next((sizes[j : i + 1] for j in range(i, -1, -1) if sum(sizes[j : i + 1]) >= 60), None)) for i, s in enumerate(sizes) if s]
        want = [(i, tuple(r)) for i, r in ahead + behind if r]
        assert at.tolist() == [i for i, _ in want]
        assert len(set(run.tolist())) == len({r for _, r in want}) == len({(h, r) for h, (_, r) in zip(run.tolist(), want)})


def licences_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["licences"] or "").split(",") for r in licenses.scan_licences(df, licenses.template_table(spark)).collect()}


def test_full_texts_and_headers(spark):
    """Every text and header of its licence, wrapped as in its file, as a whole and within another text."""
    texts = licenses.licence_texts()
    around = "This file explains how the tool is built and used.\n"
    got = licences_of(spark, [t for _, t in texts] + [around + t + "\n" + around for _, t in texts])
    assert all(licence in got[i] and licence in got[len(texts) + i] for i, (licence, _) in enumerate(texts))


def test_wrapped_notices_and_notices_inside_sentences(spark):
    gpl, bsd = "This work is licensed under the GNU\nGeneral Public License,\nversion 3.", licenses.TEMPLATES[1][1].replace("with or without ", "with or without\n")
    got = licences_of(spark, [
        f"A first sentence stands here. {gpl} Another sentence follows it.",
        f"A first sentence stands here. {bsd} Another sentence follows it.",
        "This library is released under the MIT License, see the file for what that means to you.",
        "# This work is licensed under the GNU\n# General Public License, version 3.\nimport os",
        "This library was released under another name, and the MIT course has a license plate.",
    ])
    assert [got[i] for i in range(5)] == [["GPL-3.0"], ["BSD"], ["MIT"], ["GPL-3.0"], [""]]
