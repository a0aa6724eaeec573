"""Binary bundles: framing rules, archives, event logs, decoding."""

import gzip
import io
import struct
import sys
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from sparkevents.operators import sensor
from sparkevents.plans import scalar_queries
from sparkevents.sources import frames
from sparkevents.sources.sensor_schema import message_class


def frame(data: bytes) -> bytes:
    return struct.pack("<I", len(data)) + data


def archive(**members: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return out.getvalue()


def split(spark, body):
    df = spark.createDataFrame([(1, bytearray(body))], "id int, body binary")
    return [
        (r["member"], r["idx"], None if r["frame"] is None else bytes(r["frame"]), r["error"])
        for r in frames.split_frames(df).collect()
    ]


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        (frame(b"ab") + frame(b"c"), [("", 0, b"ab", None), ("", 1, b"c", None)]),
        (b"\x01\x02\x03", [("", 0, None, frames.TOO_SHORT)]),
        (frame(b"ab") + b"\x00\x00\x00\x00", [("", 0, b"ab", None)]),
        (frame(b"ab") + b"\xff", [("", 0, b"ab", None)]),
        (frame(b"ab") + struct.pack("<I", 99) + b"x", [("", 0, b"ab", None), ("", 1, None, frames.NOT_FILLED)]),
        (archive(one=frame(b"a"), two=frame(b"b")), [("one", 0, b"a", None), ("two", 0, b"b", None)]),
        (archive(bad=b"\x01", good=frame(b"b")), [("bad", 0, None, frames.TOO_SHORT), ("good", 0, b"b", None)]),
    ],
)
def test_framing(spark, body, expected):
    assert split(spark, body) == expected


def test_damaged_member_does_not_stop_the_others(spark):
    body = bytearray(archive(bad=frame(b"a" * 50), good=frame(b"b")))
    body[60] ^= 0xFF
    assert [r[3] for r in split(spark, body)] == [frames.BAD_MEMBER, None]


def test_event_logs(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(frame(b"1") + frame(b"2"))
    (tmp_path / "b.log.gz").write_bytes(gzip.compress(frame(b"3")))
    (tmp_path / "c.txt").write_bytes(frame(b"4"))
    assert rows(frames.read_event_logs(spark, str(tmp_path)), F.col("frame").cast("string")) == [("1",), ("2",), ("3",)]


def test_read_bundles(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(archive(events=frame(b"1")))
    (tmp_path / "b.bin").write_bytes(frame(b"2"))
    found = rows(frames.read_bundles(spark, str(tmp_path)), "member", F.col("frame").cast("string"))
    assert found == [("", "2"), ("events", "1")]


def test_decode(spark):
    m = message_class()()
    m.header.version, m.header.timestamp = 4, 131000000000000000
    m.env.endpoint.SensorId = 7
    m.env.endpoint.SensorHostName = "bob"
    m.regmod.action = 2
    m.regmod.utf8_regpath = b"\\registry\\x"
    no_header = message_class()()
    no_header.regmod.action = 2
    bodies = [m.SerializeToString(), no_header.SerializePartialToString(), b"\xff\xff", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, frame binary").withColumn(
        "headers", F.create_map().cast("map<string,string>")
    )
    decoded = frames.decode_frames(df)
    assert rows(decoded, "id", "error") == [
        (0, None), (1, frames.UNDECODABLE), (2, frames.UNDECODABLE), (3, frames.UNDECODABLE),
    ]
    done = sensor.normalize_sensor(decoded.filter("error is null"), ["ingress.event.regmod"], form="columns").first()
    assert (done["path"], done["action"], done["sensor_id"]) == ("\\registry\\x", "writeval", 7)


def test_encode_is_the_inverse_of_decode(spark):
    m = message_class()()
    m.header.version = 4
    m.networkv2.remoteIpAddress.bIsIpv6 = True
    m.networkv2.remoteIpAddress.ipv6High = (1 << 64) - 1
    s = m.strings.add()
    s.guid, s.utf8string = -5, b"x"
    raw = m.SerializeToString()
    df = spark.createDataFrame([(1, bytearray(raw))], "id int, frame binary")
    again = frames.encode_frames(frames.decode_frames(df).drop("error")).first()["frame"]
    assert bytes(again) == raw


def sensor_frames(n):
    """Messages of three kinds, some without a field, a part or strings."""
    for i in range(n):
        m = message_class()()
        m.header.version = 4
        if i % 3 == 0:
            m.childproc.suppressed.SetInParent()
            m.childproc.pid, m.childproc.commandline, m.childproc.path = -i, b"\xff\x00", "\u00e9"
        if i % 3 == 1:
            m.networkv2.remoteIpAddress.ipv6High, m.networkv2.outbound = (1 << 64) - 1 - i, False
        for k in range(i % 4):
            m.strings.add().guid = k
        yield m.SerializeToString()


def python_calls(f, batch):
    """What a task gives for a batch, and how many Python functions it calls."""
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        done = list(f(iter([batch])))
    finally:
        sys.setprofile(None)
    return pa.Table.from_batches(done).combine_chunks().to_batches()[0], calls


def test_messages_are_taken_apart_and_put_together_by_columns(spark, monkeypatch):
    tasks, calls = [], {}
    df = spark.createDataFrame([], "id int, frame binary, error string")
    message = frames.decode_frames(df).drop("error")
    with monkeypatch.context() as m:
        m.setattr(type(df), "mapInArrow", lambda self, f, schema: tasks.append(f))
        frames.decode_frames(df)
        frames.encode_frames(message)
    decode, encode = tasks
    for n in (12, 12, 1200):  # the first makes the message class
        raw = list(sensor_frames(n))
        batch = pa.RecordBatch.from_pydict({"id": pa.array(range(n), pa.int32()), "frame": raw, "error": pa.nulls(n, pa.string())})
        decoded, taken = python_calls(decode, batch)
        encoded, put = python_calls(encode, decoded.drop_columns("error"))
        assert encoded.column("frame").to_pylist() == raw
        calls[n] = taken + put
    assert calls[1200] < 2 * calls[12]


def test_frames_in_a_batch_keep_their_places(spark):
    good = list(sensor_frames(6))
    bodies = [b"\xff\xff", good[1], None, good[3], good[2], b""]
    df = spark.createDataFrame([(i, b, "given" if i == 4 else None) for i, b in enumerate(bodies)], "id int, frame binary, error string")
    found = rows(frames.decode_frames(df), "id", "error", "header.version", "networkv2.remoteIpAddress.ipv6High", "childproc.pid", F.size("strings"))
    assert found == [
        (0, frames.UNDECODABLE, None, None, None, None),
        (1, None, 4, (1 << 64) - 2, None, 1),
        (2, frames.UNDECODABLE, None, None, None, None),
        (3, None, 4, None, -3, 3),
        (4, "given", None, None, None, None),
        (5, frames.UNDECODABLE, None, None, None, None),
    ]


def test_only_bodies_that_end_like_an_archive_are_opened_as_one(monkeypatch):
    def refused(*_):
        raise AssertionError("opened")

    monkeypatch.setattr(zipfile, "ZipFile", refused)
    assert list(frames.split_body(frame(b"PK\x03\x04"))) == [("", 0, b"PK\x03\x04", None)]


@pytest.mark.parametrize("scheme", ["", "file://", "file:"])
def test_runs_written_to_a_path_or_uri_come_back(spark, tmp_path, monkeypatch, scheme):
    monkeypatch.chdir(tmp_path)
    data = [(i, f"props {i}" * (i % 3 + 1)) for i in range(0, 60_000, 25)]
    runs = scalar_queries.runs_of(spark.createDataFrame(data, "event_id long, props string"), 50)
    size = F.octet_length("body")
    assert runs.count() == 2 * 6 and runs.agg(F.max("span")).first()[0] == 5  # no file spans more than its ids
    named = runs.withColumn("name", F.format_string("e-%d-%d.log%s", "bundle", "span", F.when(size % 2 == 0, ".gz").otherwise("")))
    folder = f"{scheme}{tmp_path}/a folder"
    scalar_queries.write_binary(named, folder)
    found = frames.read_event_logs(spark, folder)
    assert found.filter("error is not null").isEmpty()
    assert sorted(r[0].decode() for r in found.select("frame").collect()) == sorted(x for _, x in data)
