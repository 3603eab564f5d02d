"""Captured messages and device frames, built by hand."""

import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from seriesmill.functions import times, values
from seriesmill.functions.binary import decode_values, fixed_strings, strip_terminator
from seriesmill.schemas import CA_FRAME, CAPTURE
from seriesmill.sources import captures, device_events

STAMP = struct.pack(">QQ", 1_700_000_000, 42)


def message(msg_id, channels, payloads, source="s", pulse=14_781_000_001, hash_=None, **main):
    header = json.dumps({"htype": "bsr_d-1.1", "channels": channels}).encode()
    digest = hash_ or hashlib.md5(header).hexdigest()
    head = {"htype": "bsr_m-1.1", "pulse_id": pulse, "hash": digest, "global_timestamp": {"sec": 1_700_000_000, "ns": 1}, **main}
    frames = [json.dumps(head).encode(), header]
    for p in payloads:
        frames += [p, STAMP]
    return (msg_id, source, 1_700_000_000_000_000_000 + msg_id, [bytearray(f) for f in frames])


@pytest.fixture(scope="module")
def decoded(spark):
    messages = [
        message(1, [{"name": "a"}], [struct.pack("<d", 1.5)]),
        message(2, [{"name": "a", "type": "int32", "encoding": "big"}], [struct.pack(">i", -7)]),
        message(3, [{"name": "w", "type": "uint16", "shape": [3]}], [struct.pack("<3H", 1, 65535, 3)]),
        message(4, [{"name": "u", "type": "uint64"}], [struct.pack("<Q", 2**64 - 1)]),
        message(5, [{"name": "t", "type": "string"}], [b"abc\0def"]),
        message(6, [{"name": "b", "type": "bool", "shape": [4]}], [b"\0\1\2\0"]),
        message(7, [{"name": "a", "encoding": "middle", "compression": "none"}], [struct.pack("<d", 2.5)]),
        message(8, [{"name": "z", "compression": "lz4"}], [b"xx"]),
        message(9, [{"name": "z", "compression": "zip"}], [b"xx"]),
        message(10, [{"name": "z", "type": "complex"}], [b"xx"]),
        message(11, [{"name": "a"}, {"name": "c"}], [struct.pack("<d", 1.0)]),
        message(12, [{"name": "a"}], [struct.pack("<d", 1.0)], hash_="0" * 32),
        message(13, [{"name": "a"}], [struct.pack("<d", 1.0)], dh_compression="lz4"),
        message(14, [{"name": "a"}], [struct.pack("<d", 1.0)], dh_compression="brotli"),
        message(15, [{"name": "f", "type": "float32"}], [b"\1\2\3"]),
        (16, "s", 0, [bytearray(b"{}")]),
        (17, "s", 0, [bytearray(b"not json"), bytearray(b"{}")]),
        message(18, [{"name": "a"}], [struct.pack("<d", 1.0)], pulse=5),
    ]
    good, bad = captures.decode_headers(spark.createDataFrame(messages, CAPTURE))
    frames, unread = captures.channel_frames(good)
    return good, bad, frames, unread


def test_rejected_messages(decoded):
    reasons = {r["msg_id"]: r["reason"] for r in decoded[1].collect()}
    assert reasons == {13: "compressed data header", 16: "too few frames", 17: "bad main header"}


def test_rejected_channels(decoded):
    reasons = {(r["msg_id"], r["channel"]): r["reason"] for r in decoded[3].collect()}
    assert reasons == {
        (8, "z"): "compressed value",
        (9, "z"): "unknown compression",
        (10, "z"): "unknown type",
        (11, "c"): "message too short",
    }


def test_values(decoded):
    got = {r["msg_id"]: (r["scalar_type"], r["ints"], r["wide"] and [int(x) for x in r["wide"]], r["floats"], r["text"]) for r in captures.decode_frames(decoded[2]).collect()}
    assert got[1] == ("F64", None, None, [1.5], None)
    assert got[2] == ("I32", [-7], None, None, None)
    assert got[3] == ("U16", [1, 65535, 3], None, None, None)
    assert got[4] == ("U64", None, [2**64 - 1], None, None)
    assert got[5] == ("STRING", None, None, None, "abc")
    assert got[6] == ("BOOL", [0, 1, 1, 0], None, None, None)
    assert got[7] == ("F64", None, None, [2.5], None)
    assert got[15] == ("F32", None, None, None, None)
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 11, 12, 14, 15, 18}


def test_frame_times(decoded):
    stamps = {r["frame_ts_ns"] for r in captures.frame_times(decoded[2]).collect()}
    assert stamps == {1_700_000_000 * 10**9 + 42}


def test_checks(decoded):
    rows = {r["msg_id"]: r for r in captures.with_quality(decoded[0]).collect()}
    assert [i for i, r in rows.items() if not r["frames_ok"]] == [11]
    assert [i for i, r in rows.items() if not r["hash_ok"]] == [12]
    assert [i for i, r in rows.items() if r["pulse_out_of_range"]] == [18]
    assert rows[1]["pulse_matches_time"] and not rows[18]["pulse_matches_time"]


def test_decode_keeps_row_order(spark):
    rows = [(i, bytearray(struct.pack(">h" if i % 3 else "<d", i)), "I16" if i % 3 else "F64", bool(i % 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, p binary, k string, big boolean").repartition(3)
    got = df.select("i", decode_values("p", "k", "big").alias("v")).select("i", "v.ints", "v.floats").collect()
    assert all((r["ints"] == [r["i"]]) if r["i"] % 3 else (r["floats"] == [float(r["i"])]) for r in got)


def ca(seq, type_id, count, body, status=0, severity=0, secs=0, nanos=5):
    head = struct.pack(">HHII", status, severity, secs, nanos)
    return (seq, 0, 1, type_id, count, 1, 100 + seq, bytearray(head + body))


def test_device_frames(spark):
    frames = [
        ca(1, 14, 1, b"hello\0rest"),
        ca(2, 15, 1, b"\0\0" + struct.pack(">h", -5), status=3, severity=2),
        ca(3, 16, 1, struct.pack(">f", 0.5)),
        ca(4, 17, 1, b"\0\0" + struct.pack(">h", 4)),
        ca(5, 18, 1, b"\0\0\0" + struct.pack(">b", -1) + b"\0" * 4),
        ca(6, 19, 1, struct.pack(">i", 1 << 30)),
        ca(7, 20, 1, b"\0" * 4 + struct.pack(">d", 2.25)),
        ca(8, 20, 5, b"\0" * 4 + struct.pack(">5d", *range(5))),
        ca(9, 19, 4, struct.pack(">2i", 8, 9)),
        ca(10, 14, 2, b"ab".ljust(40, b"\0") + b"cd".ljust(40, b"\0")),
        ca(11, 17, 2, b"\0\0" + struct.pack(">2h", 6, 7)),
        ca(12, 20, 1, b"\0" * 4 + b"\1\2\3"),
        ca(13, 6, 1, b""),
        ca(14, 33, 1, b""),
        (15, 0, 1, 20, 1, 1, 0, bytearray(b"\0\1")),
        (16, 0, 7, 20, 1, 1, 0, bytearray(b"")),
    ]
    good, bad = device_events.decode_events(spark.createDataFrame(frames, CA_FRAME), array_truncate=3)
    got = {r["seq"]: r for r in good.collect()}
    assert {r["seq"]: r["reason"] for r in bad.collect()} == {
        12: "short payload",
        13: "not a time type",
        14: "bad type id",
        15: "short metadata",
    }
    assert got[1]["text"] == "hello"
    assert (got[2]["ints"], got[2]["status"], got[2]["severity"], got[2]["scalar_type"]) == ([-5], 3, 2, "I16")
    assert got[3]["floats"] == [0.5] and got[3]["status"] is None
    assert (got[4]["ints"], got[4]["scalar_type"]) == ([4], "I16")
    assert got[5]["ints"] == [-1] and got[6]["ints"] == [1 << 30] and got[7]["floats"] == [2.25]
    assert (got[8]["floats"], got[8]["shape_dims"]) == ([0.0, 1.0, 2.0], [5])
    assert got[9]["ints"] == [8, 9]
    assert got[10]["texts"] == ["ab", "cd"] and got[11]["ints"] == [6, 7]
    assert got[7]["ts_ns"] == 631152000 * 10**9 + 5
    assert got[7]["subid"] == 107


def test_text_functions(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xffb\0c"),), (bytearray(b""),), (bytearray(b"p\x20\x0az"),)], "b binary")
    got = [r[0] for r in rows.select(strip_terminator("b")).collect()]
    assert got == ["a�b", "", "p \nz"]
    texts = spark.createDataFrame([(bytearray(b"x".ljust(40, b"\0") + b"y".ljust(40, b"\0")),)], "b binary")
    assert texts.select(fixed_strings("b")).head()[0] == ["x", "y"]


def test_addresses(spark):
    rows = spark.createDataFrame([("host",), ("h:70",), ("",), ("1.2.3.4",), ("a:99999",), ("a:b:c",), (" 9.9.9.9:1 ",)], "t string")
    got = [r[0] for r in rows.select(values.normal_address("t")).collect()]
    assert got == ["host:5064", "h:70", None, "1.2.3.4:5064", None, None, "9.9.9.9:1"]
    parsed = spark.createDataFrame([("1.2.3.4:5",), ("1.2.3.400:5",), ("h:5",), ("1.2.3.4",), ("1.2.3.4:70000",)], "t string")
    assert [r[0] for r in parsed.select(values.socket_address("t")).collect()] == ["1.2.3.4:5", None, None, None, None]


def test_negative_times_floor_down(spark):
    row = spark.createDataFrame([(-1,)], "t long").select(times.floor_to("t", 10), times.bucket("t", 10), times.iso_millis("t"))
    assert tuple(row.head()) == (-10, -1, "1969-12-31T23:59:59.999Z")


def test_headers_of_a_stream(spark, tmp_path):
    spark.createDataFrame([message(1, [{"name": "a"}], [struct.pack("<d", 1.5)])], CAPTURE).write.parquet(str(tmp_path / "in"))
    live = captures.read_captures(spark, str(tmp_path / "in"), stream=True)
    frames, _ = captures.channel_frames(captures.decode_headers(live)[0])
    out = captures.decode_frames(frames).select("msg_id", F.element_at("floats", 1).alias("x"))
    query = out.writeStream.format("memory").queryName("live").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("live").collect()] == [(1, 1.5)]
