"""Ordered columns: sliced keys against plain Python."""

import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from seriesmill.operators import bins, slicing
from seriesmill.operators.slicing import LOWEST, HotKeys, Ordered, SlicePolicy, find_hot, number_rows
from seriesmill.schemas import MINUTE
from seriesmill.streaming import sliced

SMALL = SlicePolicy(max_rows=25)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out, seq = [], 0
    for key, n in [("hot", 400), ("warm", 90), ("cold", 10), (None, 60)]:
        t = 1_000_000
        for _ in range(n):
            t += rng.choice([0, 1, 5, 1000])
            out.append((key, t, seq, rng.choice([None, 1.0, 2.0, 3.5])))
            seq += 1
    rng.shuffle(out)
    return out


def expected(rows):
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    want = {}
    for rs in by_key.values():
        rs.sort(key=lambda r: (r[1], r[2]))
        total, top = 0.0, None
        for i, r in enumerate(rs):
            if r[3] is not None:
                total += r[3]
                top = r[3] if top is None else max(top, r[3])
            later = next((x for x in rs[i:] if x[3] == 3.5), None)
            want[r[2]] = (
                rs[i - 1][3] if i else None,
                rs[i + 1][1] if i + 1 < len(rs) else None,
                i,
                total,
                top,
                later[2] if later else None,
            )
    return want


@pytest.mark.parametrize("policy", [SlicePolicy(), SMALL], ids=["plain", "sliced"])
def test_ordered_columns(spark, rows, policy):
    df = spark.createDataFrame(rows, "series string, ts_ns long, seq long, value double")
    o = Ordered(df, ["series"], policy=policy)
    assert bool(o.hot) == (policy is SMALL)
    o.lag("before", "value").lead("after", "ts_ns").position("i")
    o.running_sum("total", F.coalesce("value", F.lit(0.0))).running_max("top", F.col("value"))
    o.next_match("later", F.when(F.col("value") == 3.5, F.struct("seq")))
    got = {r["seq"]: (r["before"], r["after"], r["i"], r["total"], r["top"], r["later"] and r["later"]["seq"]) for r in o.done().collect()}
    assert got == expected(rows)


def test_slices_are_bounded_and_in_time_order(spark, rows):
    df = spark.createDataFrame(rows, "series string, ts_ns long, seq long, value double")
    hot = find_hot(df, ["series"], policy=SMALL)
    tagged = hot.tag(df)
    per_slice = tagged.filter("_slice > 0").groupBy("series", "_slice").agg(F.min("ts_ns").alias("a"), F.max("ts_ns").alias("b"), F.count("*").alias("n"))
    slices = per_slice.orderBy("series", "_slice").collect()
    assert len(slices) == hot.n_slices
    assert {r["series"] for r in slices} == {"hot", "warm", None}
    for x, y in zip(slices, slices[1:]):
        assert x["series"] != y["series"] or x["b"] < y["a"]
    assert tagged.filter("_slice = 0").select("series").distinct().collect()[0][0] == "cold"


def test_number_of_slices_has_a_limit(spark):
    df = spark.range(4000).select((F.col("id") % 40).alias("series"), F.col("id").alias("ts_ns"))
    hot = find_hot(df, ["series"], policy=SlicePolicy(max_rows=10, max_slices=30))
    assert hot.n_slices <= 2 * 30


@pytest.mark.parametrize("spread", [0, 1_000_000_000])
def test_a_burst_is_cut_by_rank(spark, spread):
    """99 % of a key's rows at one time, or within one second of a year, make slices of the usual size, in order."""
    year = 365 * 86_400 * 1_000_000_000
    late = F.when(F.col("id") % 100 == 0, F.col("id") * (year // 20_000)).otherwise(year // 3 + (F.col("id") * 7919) % (spread + 1))
    df = spark.range(20_000).select(F.lit("k").alias("series"), (late + 1_700_000_000_000_000_007).alias("ts_ns"), F.col("id").alias("seq"))
    hot = find_hot(df, ["series"], policy=SlicePolicy(max_rows=1000), tie="seq")
    place = F.struct("ts_ns", "seq")
    slices = hot.tag(df).groupBy("_slice").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("n")).orderBy("_slice").collect()
    assert len(slices) >= 20 and max(r["n"] for r in slices) <= 2000
    assert all(x["b"] < y["a"] for x, y in zip(slices, slices[1:]))
    got = Ordered(df, ["series"], policy=SlicePolicy(max_rows=1000)).position("i").lag("before", "seq").done().orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(20_000))
    assert all(x["seq"] == y["before"] and (x["ts_ns"], x["seq"]) < (y["ts_ns"], y["seq"]) for x, y in zip(got, got[1:]))


def test_a_row_is_placed_without_a_pass_over_its_cuts(spark):
    """Slices by halving: those of a sorted search, with work per row that hardly grows with the cuts."""
    rng, n = random.Random(3), 3000
    cuts = sorted({(rng.randrange(2000), rng.choice([LOWEST, 3, 8])) for _ in range(n)})
    rows = [("a", rng.randrange(-5, 2005) if rng.random() < 0.99 else None, rng.choice([None, *range(10)])) for _ in range(4000)] + [("b", 5, 5)]
    df = spark.createDataFrame(rows, "series string, ts_ns long, seq long")
    table = spark.createDataFrame([("a", [t for t, _ in cuts], [s for _, s in cuts])], "series string, _cut_t array<long>, _cut_s array<long>")
    hot = HotKeys(("series",), "ts_ns", "seq", table, len(cuts) + 1, len(cuts))
    for r in hot.tag(df).collect():
        place = (r["ts_ns"], LOWEST if r["seq"] is None else r["seq"])
        assert r["_slice"] == (0 if r["series"] == "b" else 1 if r["ts_ns"] is None else 1 + bisect_right(cuts, place))
    plan = hot.tag(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "filter(" not in plan.replace("Filter", "")


def test_a_row_is_not_given_all_cuts_of_its_key(spark, monkeypatch):
    """Keys of few and many cuts, a null key among them: slices of a sorted search, by arrays of about the square root of the cuts."""
    rng = random.Random(5)
    cuts = {k: sorted({(rng.randrange(2000), rng.choice([LOWEST, 3, 8])) for _ in range(n)}) for k, n in [("a", 1), ("b", 2), (None, 37), ("d", 1500)]}
    most = max(len(c) for c in cuts.values())
    table = spark.createDataFrame([(k, [t for t, _ in c], [s for _, s in c]) for k, c in cuts.items()], "series string, _cut_t array<long>, _cut_s array<long>")
    rows = [(k, rng.randrange(-5, 2005) if rng.random() < 0.98 else None, rng.choice([None, *range(10)])) for k in [*cuts, "cold"] for _ in range(600)]
    given, join = [], slicing.join_small
    monkeypatch.setattr(slicing, "join_small", lambda df, small, *how: given.append(small) or join(df, small, *how))
    hot = HotKeys(("series",), "ts_ns", "seq", table, sum(len(c) + 1 for c in cuts.values()), most)
    for r in hot.tag(spark.createDataFrame(rows, "series string, ts_ns long, seq long")).collect():
        place = (r["ts_ns"], LOWEST if r["seq"] is None else r["seq"])
        assert r["_slice"] == (0 if r["series"] == "cold" else 1 if r["ts_ns"] is None else 1 + bisect_right(cuts[r["series"]], place))
    sizes = [len(v) for small in given for r in small.collect() for v in r if isinstance(v, list)]
    assert max(sizes) <= 2 * most**0.5


def test_one_file_of_a_stream_is_dealt_over_the_cores(spark):
    rows = spark.range(1000).coalesce(1)
    dealt = sliced._dealt(rows)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and sorted(r[0] for r in dealt.collect()) == list(range(1000))


def brute_bins(events, width, carry=None):
    """Bins from the definition, nanosecond spans by hand."""
    out, by_key = {}, {}
    for e in events:
        by_key.setdefault(e[0], []).append(e)
    for key, es in by_key.items():
        es.sort(key=lambda e: (e[1], e[2]))
        acc = {}
        for i, (_, t, _, v) in enumerate(es):
            end = es[i + 1][1] if i + 1 < len(es) else t
            if carry is not None:
                end = min(end, t + carry)
            b = t // width
            while True:
                w = max(0, min(end, (b + 1) * width) - max(t, b * width))
                a = acc.setdefault(b, [0, [], 0.0, 0.0, None])
                a[0] += b == t // width
                a[1].append(v)
                a[2] += v * w
                a[3] += w
                a[4] = v
                b += 1
                if b * width >= end:
                    break
        for b, (n, vs, s, w, last) in acc.items():
            out[key, b] = (n, min(vs), max(vs), s / w if w else last)
    return out


@pytest.mark.parametrize("policy", [SlicePolicy(), SMALL], ids=["plain", "sliced"])
@pytest.mark.parametrize("carry", [None, 2 * MINUTE])
def test_bins_against_definition(spark, policy, carry):
    rng = random.Random(11)
    events, seq = [], 0
    for key, n in [("a", 200), ("b", 40), ("c", 1)]:
        t = 1_700_000_000_000_000_000 - 1_700_000_000_000_000_000 % MINUTE
        for _ in range(n):
            events.append((key, t, seq, rng.random()))
            t += rng.choice([0, MINUTE // 3, MINUTE, 5 * MINUTE, rng.randrange(MINUTE)])
            seq += 1
    df = spark.createDataFrame(events, "series string, ts_ns long, seq long, value double")
    got = bins.time_weighted_bins(df, MINUTE, max_carry_ns=carry, policy=policy).collect()
    want = brute_bins(events, MINUTE, carry)
    assert len(got) == len(want)
    for r in got:
        n, lo, hi, avg = want[r["series"], r["bin"]]
        assert (r["count"], r["min"], r["max"]) == (n, lo, hi)
        assert r["avg"] == pytest.approx(avg, rel=1e-12)


def test_patches_drop_incomplete_ends(spark):
    binned = spark.createDataFrame([("a", b, 1, 0.0, 1.0, 0.5) for b in range(3, 14)], "series string, bin long, count long, min double, max double, avg double")
    patches = bins.bin_patches(binned, MINUTE, 4).orderBy("off_lsp").collect()
    assert [(p["off_msp"], p["off_lsp"], len(p["counts"])) for p in patches] == [(0, 1, 4), (0, 2, 4)]


def test_a_gap_of_ten_years_is_one_run(spark):
    years = 10 * 365 * 24 * 60
    df = spark.createDataFrame([("a", 0, 0, 1.5), ("a", years * MINUTE, 1, 2.5), ("b", 30, 2, 4.0)], "series string, ts_ns long, seq long, value double")
    runs = bins.bin_runs(df, MINUTE, max_carry_ns=None)
    got = sorted(tuple(r) for r in runs.collect())
    assert got == [("a", 0, 0, 1, 1.5, 1.5, 1.5), ("a", 1, years - 2, 0, 1.5, 1.5, 1.5), ("a", years - 1, years - 1, 0, 1.5, 1.5, 1.5), ("a", years, years, 1, 2.5, 2.5, 2.5), ("b", 0, 0, 1, 4.0, 4.0, 4.0)]
    some = bins.expand_runs(runs, MINUTE, years - 10_000, years - 2).filter("series = 'a'")
    assert [r["bin"] for r in some.orderBy("bin").collect()] == list(range(years - 10_000, years - 1))
    assert bins.time_weighted_bins(df, MINUTE, max_carry_ns=None).filter("series = 'a'").count() == years + 1


def test_rows_numbered_by_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), F.lit(None).cast("string").alias("other"))
    got = number_rows(df.repartition(7), ["x"], "place").orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(5000)) and [r["x"] for r in got] == sorted(r["x"] for r in got)
    assert number_rows(df.filter("x < 0"), ["x"], "place").count() == 0
