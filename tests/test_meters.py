"""Moving rates against meters that are told tick by tick; throughput reported by running jobs and streams."""

import math
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from sparkevents.operators import meters, stats
from sparkevents.streaming import flows

START = 1_700_000_000 // 3600 * 3600


def told(events, first, last, minutes):
    """Rates of (events, bytes) after each tick, by the meter's own rule."""
    rate, history = None, {}
    for tick in range(first, last + 1):
        here = [n for t, n in events if t // 5 == tick]
        now = (len(here) / 5, sum(here) / 5)
        a = 1 - math.exp(-5 / 60 / minutes)
        rate = now if rate is None else tuple(r + a * (x - r) for r, x in zip(rate, now))
        history[tick] = rate
    return history


@pytest.fixture(scope="module")
def events():
    times = [0, 0, 1, 4, 5, 61, 62, 300, 301, 302, 303, 1800, 1801, 3599, 3600, 4000, 4000, 9000, 9004]
    return [("a" if i % 3 else "b", START + t, "x" * (i % 7)) for i, t in enumerate(times)]


@pytest.fixture(scope="module")
def table(spark, events):
    df = spark.createDataFrame([*events, ("a", None, "no time")], "key string, s long, body string")
    return df.withColumn("ingest_ts", F.timestamp_seconds("s"))


def test_meters(table, events):
    first, last = START // 5, (START + 9004) // 5
    found = {r["key"]: r for r in meters.meters(table, by=["key"]).collect()}
    for key in "ab":
        own = [(t, len(body)) for k, t, body in events if k == key]
        assert (found[key]["n_events"], found[key]["n_bytes"]) == (len(own), sum(n for _, n in own))
        assert found[key]["events_per_s"] == pytest.approx(len(own) / ((last - first + 1) * 5))
        for m in meters.MINUTES:
            n, size = told(own, first, last, m)[last]
            assert found[key][f"events_per_s_{m}m"] == pytest.approx(n, rel=1e-9, abs=1e-15)
            assert found[key][f"bytes_per_s_{m}m"] == pytest.approx(size, rel=1e-9, abs=1e-15)


@pytest.mark.parametrize("every", [300, 3600])
def test_readings(table, events, every):
    found = meters.meter_readings(table, every, by=["key"]).withColumn("read_s", F.unix_seconds("read_at")).collect()
    assert {(r["key"], r["read_s"]) for r in found} == {(k, (t // every + 1) * every) for k, t, _ in events}
    for r in found:
        own = [(t, len(body)) for k, t, body in events if k == r["key"]]
        last = r["read_s"] // 5 - 1
        for m in meters.MINUTES:
            n, size = told(own, START // 5, last, m)[last]
            assert r[f"events_per_s_{m}m"] == pytest.approx(n, rel=1e-9)
            assert r[f"bytes_per_s_{m}m"] == pytest.approx(size, rel=1e-9, abs=1e-15)


def test_spans_and_empty_tables(table):
    assert meters.meters(table.limit(0)).first()["n_events"] == 0 and meters.meter_readings(table.limit(0)).count() == 0
    assert meters.meters(table.limit(0), by=["key"]).count() == 0
    assert meters.meters(table, span=(START // 5, START // 5)).first()["n_events"] == 4
    with pytest.raises(ValueError):
        meters.meter_readings(table, 7)


def test_observed_batch(spark):
    df = spark.createDataFrame([("abc", "xy", None), ("d", None, "bad")], "body string, value string, error string")
    seen = Observation("batch")
    assert stats.observed(df, seen).count() == 2
    assert seen.get == stats.throughput_stats(df).first().asDict()


def test_observed_stream(spark, tmp_path):
    df = spark.createDataFrame([("abc", "xy", None), ("d", None, "bad"), ("ef", "z", None)], "body string, value string, error string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    totals = flows.Throughput("seen")
    spark.streams.addListener(totals)
    try:
        flows.run_to_table(stats.observed(stream, "seen"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        until = time.monotonic() + 20
        while totals.totals.get("input_events") != 3 and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(totals)
    assert totals.totals == stats.throughput_stats(df).first().asDict()
