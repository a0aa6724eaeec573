"""Packing, numbering and payloads, against a sequential reading of the rules."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from sparkevents.operators import bundles, ordered, sinks, stats


def brute(sizes, limit, mode, carry=0):
    """Indexes that open a bundle, and the bytes left in the open one."""
    starts, current = [], carry
    for i, size in enumerate(sizes):
        if mode == bundles.GREEDY:
            if current == 0 or current + size > limit:
                starts.append(i)
                current = 0
            current += size
        else:
            if current == 0:
                starts.append(i)
            current += size
            current = 0 if current >= limit else current
    return starts, current


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.integers(1, 40), min_size=1, max_size=30), st.integers(1, 50), st.sampled_from(["greedy", "fill"]), st.integers(0, 60)
)
def test_rule_matches_a_sequential_scan(sizes, limit, mode, carry):
    carry = min(carry, limit - 1) if mode == "fill" else carry
    prefix = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    starts, left = brute(sizes, limit, mode, carry)
    assert list(bundles.starts_from(prefix, carry, limit, mode)) == starts
    a = bundles.answers(prefix, limit, mode)
    if carry == 0:
        assert (a["fresh_bundles"], a["fresh_carry"]) == (len(starts), left)
        return
    at = int(np.searchsorted(a["room_from"], limit - carry, side="right")) - 1
    out = carry + a["bytes"] if a["carry_out"][at] == -1 else a["carry_out"][at]
    assert (a["new_bundles"][at], out) == (len(starts), left)


def test_known_bundles(spark):
    data = [("a", 1, "x" * 6), ("a", 2, "x" * 6), ("a", 3, "x" * 3), ("b", 1, "x" * 20)]
    df = spark.createDataFrame(data, "k string, n long, value string")
    packed = bundles.pack_bundles(df, "k", "n", 10)
    assert rows(packed, "k", "n", "bundle_no") == [("a", 1, 0), ("a", 2, 1), ("a", 3, 1), ("b", 1, 0)]


@pytest.mark.parametrize("mode", ["greedy", "fill"])
@pytest.mark.parametrize("per_segment", [7, 40, 10_000])
def test_hot_key_is_cut_into_segments(spark, mode, per_segment):
    rnd = random.Random(5)
    data = [(rnd.choice(["hot"] * 6 + ["x", "y", None]), i * 3 + 1, "é" * rnd.randint(1, 9)) for i in range(600)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k string, n long, value string")
    packed = bundles.pack_bundles(df, "k", "n", 60, mode, rows_per_segment=per_segment)
    got = {(r["k"], r["n"]): r["bundle_no"] for r in packed.collect()}
    assert len(got) == len(data)
    for key in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == key), key=lambda d: d[1])
        starts, _ = brute([len(d[2].encode()) for d in mine], 60, mode)
        number, expected = -1, {}
        for i, d in enumerate(mine):
            number += i in starts
            expected[(key, d[1])] = number
        assert {k: v for k, v in got.items() if k[0] == key} == expected


def test_time_order_column(spark):
    df = spark.range(50).select(
        F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 7 + 1_700_000_000).alias("ts"), F.lit("xxxx").alias("value")
    )
    packed = bundles.pack_bundles(df, "k", "ts", 10, rows_per_segment=8)
    assert [r["bundle_no"] for r in packed.orderBy("ts").collect()] == [i // 2 for i in range(50)]


def test_running_sums_over_segments(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    whole = ordered.number_rows(df, ["k"], "n", "pos")
    cut = ordered.number_rows(df, ["k"], "n", "pos", rows_per_segment=9)
    assert rows(whole) == rows(cut) and max(r["pos"] for r in whole.collect()) == 33


def test_segments_are_balanced(spark):
    df = spark.range(10_000).select((F.col("id") * F.col("id")).alias("n"))
    cut, several = ordered.with_segment(df, "n", 500)
    sizes = [r["count"] for r in cut.groupBy("_segment").count().collect()]
    assert several and len(sizes) == 20 and max(sizes) < 700


def test_dropped_since_reconnect(spark):
    data = [("d", i, i not in (2, 3, 7)) for i in range(10)]
    df = spark.createDataFrame(data, "dest string, seq long, connected boolean")
    assert rows(stats.dropped_since_reconnect(df)) == [("d", 2, 2), ("d", 7, 1)]
    assert rows(stats.dropped_since_reconnect(df, rows_per_segment=3)) == [("d", 2, 2), ("d", 7, 1)]


def payload(spark, build, **options):
    data = [("b", 2, '{"x":2}'), ("b", 1, '{"x":1}'), ("b", 3, "")]
    df = spark.createDataFrame(data, "b string, n long, value string")
    return build(df, ["b"], "n", **options).first()


def test_http_payload(spark):
    row = payload(spark, bundles.http_payload, service="svc")
    assert row["payload"] == '{"filename": "b", "service": "svc", "alerts":[{"x":1}\n, {"x":2}]}' and row["n_events"] == 2
    assert len(json.loads(row["payload"])["alerts"]) == 2
    assert payload(spark, bundles.http_payload, leef=True)["payload"] == '{"x":1}\n{"x":2}\n'
    assert payload(spark, bundles.http_payload, template="{filename}:{events}!")["payload"] == 'b:{"x":1}\n, {"x":2}!'


def test_splunk_payload(spark):
    row = payload(spark, bundles.splunk_payload, sourcetype="s")
    assert row["payload"] == '{"sourcetype":"s","event":{"x":1}}{"sourcetype":"s","event":{"x":2}}'


def test_time_bundles_with_empty_ones(spark):
    df = spark.createDataFrame([(0, "a"), (1000, "bb")], "s long, value string").withColumn("ingest_ts", F.timestamp_seconds("s"))
    found = bundles.time_bundles(df, "5 minutes", keep_empty=True)
    assert [r["n_events"] for r in found.orderBy("bundle_start").collect()] == [1, 0, 0, 1]


def test_a_clock_years_off(spark):
    far = 50 * 365 * 86400
    df = spark.createDataFrame([(-400, "a"), (0, "b"), (299, "c"), (far, "d"), (None, "e")], "s long, value string")
    found = bundles.time_bundles(df.withColumn("ingest_ts", F.timestamp_seconds("s")), "5 minutes", keep_empty=True)
    counts = found.agg(F.count("*"), F.countDistinct("bundle_start"), F.sum("n_events"), F.sum((F.col("n_events") == 0).cast("int"))).first()
    slots = far // 300 + 3
    assert tuple(counts) == (slots, slots, 4, slots - 3)
    assert bundles.time_bundles(df.limit(0).withColumn("ingest_ts", F.timestamp_seconds("s")), keep_empty=True).count() == 0


def test_chunk_key(spark):
    key = bundles.chunk_key(F.lit("events"), F.lit("2024-01-02 03:04:05").cast("timestamp"), F.lit(1), "p", ".gz")
    assert spark.range(1).select(key).first()[0] == "p/events.2024-01-02T03:04:05.000-1.gz"


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("k", i, f"line {i}") for i in range(20)], "k string, n long, value string")
    for codec in ("gzip", "lz4", "none"):
        sinks.write_compressed(df, str(tmp_path / codec), codec)
        assert spark.read.text(str(tmp_path / codec)).count() == 20
    with pytest.raises(ValueError):
        sinks.write_compressed(df, str(tmp_path / "bad"), "zip")
    sinks.write_chunks(df, str(tmp_path / "chunks"), "k", "n", 25, workers=2)
    back = spark.read.text(str(tmp_path / "chunks" / "k=k" / "chunk_no=0"))
    assert [r["value"] for r in back.collect()] == ["line 0", "line 1", "line 2", "line 3", "line 4"][:5]


def test_gzip_level(spark, tmp_path):
    df = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("value")).coalesce(1)
    sizes = []
    for level in (1, 9):
        sinks.write_compressed(df, str(tmp_path / str(level)), "gzip", level)
        sizes.append(sum(f.stat().st_size for f in (tmp_path / str(level)).glob("*.gz")))
    assert sizes[1] < sizes[0]


def test_topics(spark, tmp_path):
    data = [('{"type":"ingress.event.netconn"}',), ('{"type":5}',), ("junk",), ('{"a":1}',)]
    df = spark.createDataFrame(data, "value string")
    assert rows(sinks.topic_records(df, suffix=".x"), "topic") == [("netconn.x",)]
    assert sinks.topic_records(df, topic="all").count() == 4
    sinks.write_topics(sinks.topic_records(df), str(tmp_path / "topics"))
    assert (tmp_path / "topics" / "topic=netconn").is_dir()
