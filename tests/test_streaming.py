"""Streams: stateful packing, delivery, daily sink."""

import time

from pyspark.sql import functions as F

from conftest import rows
from sparkevents.operators import bundles
from sparkevents.streaming import flows, packing


def write(spark, path, data):
    spark.createDataFrame(data, "k string, n long, value string").coalesce(1).write.mode("append").parquet(path)


def drain(stream, path, checkpoint):
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(
        path
    ).awaitTermination()
    return stream.sparkSession.read.parquet(path)


def test_packing_state_survives_restarts(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    data = [(k, i, "x" * (i % 7 + 1)) for i in range(60) for k in ("a", "b")]
    expected = rows(bundles.pack_bundles(spark.createDataFrame(data, "k string, n long, value string"), "k", "n", 20), "k", "n", "bundle_no")
    for part in (data[:40], data[40:41], data[41:]):
        write(spark, source, part)
        stream = spark.readStream.schema("k string, n long, value string").parquet(source)
        found = drain(packing.stream_pack_bundles(stream, ["k"], "n", 20), out, checkpoint)
    assert rows(found, "k", "n", "bundle_no") == expected


def test_packing_by_age(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for i in range(2):
        write(spark, source, [("a", i, "x")])
        stream = spark.readStream.schema("k string, n long, value string").parquet(source)
        packed = packing.stream_pack_bundles(stream, ["k"], "n", 1000, max_age_seconds=1)
        found = drain(packed, out, checkpoint)
        time.sleep(1.2)
    assert rows(found, "n", "bundle_no") == [(0, 0), (1, 1)]


def test_packing_over_workers_keeps_every_record(spark, tmp_path):
    source = str(tmp_path / "in")
    write(spark, source, [("a", i, "x" * 5) for i in range(50)])
    stream = spark.readStream.schema("k string, n long, value string").parquet(source)
    found = drain(packing.stream_pack_bundles(stream, ["k"], "n", 10, workers=4), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert found.count() == 50 and found.select("worker").distinct().count() == 4
    assert found.groupBy("worker", "bundle_no").count().filter("count > 2").count() == 0


def test_closings_by_size(spark, tmp_path):
    source = str(tmp_path / "in")
    sizes = {"a": [4, 4, 4, 9, 2], "b": [1]}
    write(spark, source, [(k, i, "x" * s) for k, v in sizes.items() for i, s in enumerate(v)])
    for mode, expected in (("greedy", [(0, 2, 8), (1, 1, 4), (2, 1, 9)]), ("fill", [(0, 3, 12), (1, 2, 11)])):
        stream = spark.readStream.schema("k string, n long, value string").parquet(source)
        packed = packing.stream_pack_bundles(stream, ["k"], "n", 10, mode, closings=True)
        found = drain(packed, str(tmp_path / mode), str(tmp_path / f"cp-{mode}"))
        assert rows(found.filter("closed = 'size' and n is null"), "bundle_no", "n_events", "n_bytes") == expected
        assert found.filter("closed is null").count() == 6
        texts = spark.read.parquet(source)
        back = packing.with_texts(texts, found, ["k"], "n")
        batch = bundles.pack_bundles(texts, "k", "n", 10, mode)
        assert rows(back, "k", "n", "value", "bundle_no") == rows(batch, "k", "n", "value", "bundle_no")


def test_a_quiet_key_s_bundle_closes_by_timer(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, source, [("a", 0, "xx"), ("a", 1, "y"), ("b", 0, "z")])
    stream = spark.readStream.schema("k string, n long, value string").parquet(source)
    packed = packing.stream_pack_bundles(stream, ["k"], "n", 1000, max_age_seconds=2, timers=True, keep_empty=True, closings=True)
    query = (
        packed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(processingTime="500 milliseconds").start(out)
    )
    try:
        until = time.time() + 60
        while time.time() < until:
            found = spark.read.schema(packed.schema).parquet(out) if list((tmp_path / "out").glob("*.parquet")) else None
            if found is not None and found.filter("closed = 'empty'").count() >= 2:
                break
            time.sleep(1)
    finally:
        query.stop()
    assert rows(found.filter("closed = 'age'"), "k", "bundle_no", "n_events", "n_bytes") == [("a", 0, 2, 3), ("b", 0, 1, 1)]
    assert {(r["k"], r["bundle_no"], r["n_events"]) for r in found.filter("closed = 'empty'").collect()} >= {("a", 1, 0), ("b", 1, 0)}


def test_failed_bundles_are_sent_with_later_batches(spark, tmp_path):
    source, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    schema = "bundle_id string, payload string"
    calls = tmp_path / "up"

    def post(body, headers):
        return (200, None) if calls.exists() or body == b"ok" else (503, "busy")

    for number, payload in enumerate(["late", "ok", "late too"]):
        spark.createDataFrame([(f"b{number}", payload)], schema).coalesce(1).write.mode("append").parquet(source)
        if number == 2:
            calls.touch()
        stream = spark.readStream.schema(schema).parquet(source)
        flows.stream_deliver(stream, ledger, str(tmp_path / "cp"), post).awaitTermination()
    found = rows(spark.read.parquet(ledger).groupBy("bundle_id").agg(F.count("status"), F.min("status")))
    assert found == [("b0", 3, 200), ("b1", 1, 200), ("b2", 1, 200)]


def test_daily_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([(0, "x"), (86400, "y"), (86401, "")], "s long, value string")
    df.select(F.timestamp_seconds("s").alias("ingest_ts"), "value").write.parquet(source)
    stream = spark.readStream.schema("ingest_ts timestamp, value string").parquet(source)
    flows.stream_daily_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    found = spark.read.schema("value string, day string").text(str(tmp_path / "out"))
    assert rows(found, "day", "value") == [("19700101", "x"), ("19700102", "y")]
