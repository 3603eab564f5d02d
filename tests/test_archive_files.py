"""Versioned lists of files: pruning, compaction, expiry and readers in between."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from seriesmill.schemas import DAY, HOUR, REGISTRY
from seriesmill.sinks import archive_files, tables
from seriesmill.sources import archive

START = 1_704_067_200 * 1_000_000_000


def event_rows(spark, n, batch=0, n_series=40):
    i = F.col("id") + batch * n
    return spark.range(n).select(
        (i % n_series).alias("series"), (START + i * 1_000_000).alias("ts_ns"), F.lit(START).alias("ts_msp"), (i * 1_000_000).alias("ts_lsp"), i.alias("seq"),
        F.array().cast("array<int>").alias("shape_dims"), F.lit("F64").alias("scalar_type"), i.cast("double").alias("fvalue"), F.lit(None).cast("long").alias("ts_msp_grid"),
    )


def seqs(df):
    return sorted(r["seq"] for r in df.select("seq").collect())


def test_a_channel_opens_a_tenth_of_a_day(spark, tmp_path):
    archived = archive_files.ArchiveFiles(spark, str(tmp_path))
    archived.append(tables.event_rows(event_rows(spark, 20_000)), "events", 0, START, rows_per_file=500)
    n_files = archived.files("events").count()
    known = spark.createDataFrame([(7, "lab", "C7", 10, [], 0), (8, "lab", "C8", 10, [], 0)], REGISTRY)
    found = archive.read_channel(archived, known, "lab", "C7", START, START + DAY)
    assert n_files >= 40 and len(found.inputFiles()) <= n_files / 10
    assert seqs(found) == list(range(7, 20_000, 40))
    early = archive.read_channel(archived, known, "lab", "C7", START, START + 100 * 1_000_000)
    assert seqs(early) == [7, 47, 87]
    assert archive.read_channel(archived, known, "lab", "none", START, START + DAY).count() == 0
    assert archived.read("events_scalar", series=[]).count() == 0


def test_fifty_micro_batches_end_in_few_files(spark, tmp_path):
    archived = archive_files.ArchiveFiles(spark, str(tmp_path))
    for b in range(50):
        assert archived.append(tables.event_rows(event_rows(spark, 20, b)), "events", b, START + b) == b + 1
    assert archived.append(tables.event_rows(event_rows(spark, 20, 3)), "events", 3, START + 60) is None
    reader = archived.read("events_scalar")
    assert archived.compact("events", START + HOUR // 2) is None  # too young
    assert archived.compact("events", START + 2 * HOUR) == 51
    assert archived.files("events").count() <= 2
    assert seqs(reader) == seqs(archived.read("events_scalar")) == list(range(1000))
    assert {r["batch"] for r in archived.read("events_scalar").select("batch").distinct().collect()} == set(range(50))
    # a batch that was joined with others is still known, and the old files go only when no version lists them
    assert archived.append(tables.event_rows(event_rows(spark, 20, 3)), "events", 3, START + 60) is None
    assert archived.vacuum("events", keep_versions=2) == 0 and seqs(reader) == list(range(1000))
    assert archived.vacuum("events", keep_versions=1) == 50 and archived.versions("events") == [51]
    assert seqs(archived.read("events_scalar")) == list(range(1000))


def test_expiry_goes_by_the_age_of_rows(spark, tmp_path):
    archived, keep = archive_files.ArchiveFiles(spark, str(tmp_path)), {"scalar": 10 * DAY}
    for b in range(4):
        archived.append(tables.event_rows(event_rows(spark, 10, b)), "events", b, START + b * 4 * DAY)
    assert archived.expire("events", START + 9 * DAY, keep) is None
    archived.compact("events", START + 13 * DAY, least=2, retention=keep)
    # the first batch was expired and not copied; the others share files, and the second is expired now
    now = START + 17 * DAY
    archived.expire("events", now, keep)
    assert seqs(archived.read("events_scalar", written_after=now - 10 * DAY)) == list(range(20, 40))
    assert set(range(10)).isdisjoint(seqs(archived.read("events_scalar")))
    archived.expire("events", START + 40 * DAY, keep)
    assert archived.read("events_scalar").count() == 0


def test_writers_that_meet_do_not_lose_each_others_files(spark, tmp_path, monkeypatch):
    one, two = archive_files.ArchiveFiles(spark, str(tmp_path)), archive_files.ArchiveFiles(spark, str(tmp_path))
    one.append(tables.event_rows(event_rows(spark, 10)), "events", 0, START)
    meanwhile = iter([lambda: two.append(tables.event_rows(event_rows(spark, 10, 1)), "events", 1, START)])
    fs = one._fs

    def late(path):
        if path.endswith("000000000002"):
            for act in meanwhile:
                act()
        return fs(path)

    monkeypatch.setattr(one, "_fs", late)
    assert one.append(tables.event_rows(event_rows(spark, 10, 2)), "events", 2, START) == 3
    assert seqs(one.read("events_scalar")) == list(range(30))


def test_status_tables_without_series(spark, tmp_path):
    archived = archive_files.ArchiveFiles(spark, str(tmp_path))
    rows = tables.status_rows(spark.createDataFrame([("a:1", 2, START), ("b:2", 3, START + DAY)], "addr string, kind int, ts_ns long"))
    archived.append(rows, "connection_status", 0, START)
    assert archived.files("connection_status").count() == 2
    late = archived.read("connection_status", from_time=START + HOUR)
    assert [r["addr"] for r in late.collect()] == ["b:2"] and len(late.inputFiles()) == 1
    assert archived.read("muted").count() == 0
    with pytest.raises((KeyError, Py4JJavaError)):
        archived.read("no such table")
