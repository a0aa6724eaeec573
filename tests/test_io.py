"""Sources, comparison, delivery and the error branch on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sparkevents.operators import delivery, diff, filters, sinks, stats
from sparkevents.sources import audit, envelope


def test_envelope_files(spark, tmp_path):
    data = [(bytearray(b"{}"), "a.b", "application/json", "api.events", {"sensorId": "1"}, None)]
    spark.createDataFrame(data, envelope.ENVELOPE).write.parquet(str(tmp_path / "e"))
    assert envelope.read_envelope(spark, str(tmp_path / "e")).first()["headers"] == {"sensorId": "1"}
    spark.createDataFrame(data, envelope.ENVELOPE).write.json(str(tmp_path / "j"))
    assert bytes(envelope.read_envelope(spark, str(tmp_path / "j"), "json").first()["body"]) == b"{}"


def test_routing_dirs(spark, tmp_path):
    for key, n in (("binaryinfo.observed", 0), ("binaryinfo.observed", 1), ("cmd.feed.synchronize", 0)):
        (tmp_path / key).mkdir(exist_ok=True)
        (tmp_path / key / f"{n}.json").write_text('{"a":\n1}')
    found = envelope.read_routing_dirs(spark, str(tmp_path))
    assert rows(found, "routing_key", "file", F.col("body").cast("string")) == [
        ("binaryinfo.observed", "0", '{"a":\n1}'), ("binaryinfo.observed", "1", '{"a":\n1}'),
        ("cmd.feed.synchronize", "0", '{"a":\n1}'),
    ]


def test_export_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"type":"t"}\n[1]\n\n{bad\n')
    found = envelope.read_json_lines_export(spark, str(tmp_path / "*.json"))
    assert found.count() == 3 and found.filter("error is null").count() == 1


def test_audit_logs(spark, tmp_path):
    (tmp_path / "banning.log").write_text("one\ntwo\n")
    (tmp_path / "isolation.log").write_text("three\n")
    (tmp_path / "other.log").write_text("four\n")
    assert rows(audit.tail_audit_logs(spark, str(tmp_path))) == [
        ("one", "audit.log.banning"), ("three", "audit.log.isolation"), ("two", "audit.log.banning"),
    ]


def test_capture_raw_numbers_per_key(spark, tmp_path):
    data = [(i, "application/json", "a" if i % 3 else "b", bytearray(b"x")) for i in range(9)]
    df = spark.createDataFrame(data, "id long, content_type string, routing_key string, body binary")
    captured = sinks.capture_raw(df, str(tmp_path / "raw"), "id", rows_per_segment=2)
    assert rows(captured.filter("routing_key = 'b'"), "file") == [(f"json/b/{n}.json",) for n in range(3)]
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 9


def lines(spark, *values):
    return spark.createDataFrame([("f", i, json.dumps(v) if v is not None else None) for i, v in enumerate(values)],
                                 "file string, line long, value string")


def nested(depth, value):
    return {"a": nested(depth - 1, value)} if depth else value


DIFFS = [
    ({"a": 1}, {"a": 1}, []),
    ({"a": 1, "b": 2}, {"b": 2, "a": 1}, []),
    ({"a": 1}, {"a": 2}, [(".a", "value", "1", "2")]),
    ({"a": 1}, {}, [(".a", "missing", "1", None)]),
    ({}, {"a": {"b": 1}}, [(".a", "extra", None, None)]),
    ({"a": 1}, {"a": "1"}, [(".a", "type", "1", "1")]),
    ({"a": 1}, {"a": 1.5}, [(".a", "type", "1", "1.5")]),
    ({"a": [1, 2]}, {"a": [1]}, [(".a", "length", "2", "1")]),
    ({"a": [1, {"b": None}]}, {"a": [1, {"b": False}]}, [(".a[1].b", "type", None, "false")]),
    ({"a": {"x": 1}}, {"a": [1]}, [(".a", "type", None, None)]),
    ({"a.b": 1, "a": {"b": 2}}, {"a.b": 1, "a": {"b": 3}}, [(".a.b", "value", "2", "3")]),
    ([1], [2], [("[0]", "value", "1", "2")]),
    (nested(12, 1), nested(12, 2), [(".a" * 12, "value", "1", "2")]),
    (nested(9, [1]), nested(9, {"b": 1}), [(".a" * 9, "type", None, None)]),
]


@pytest.mark.parametrize("case", range(len(DIFFS)))
def test_diff(spark, case):
    gold, new, expected = DIFFS[case]
    found = diff.diff_tables(lines(spark, gold), lines(spark, new), ["file", "line"])
    assert rows(found, "path", "problem", "gold_value", "new_value") == expected


def test_diff_of_missing_lines(spark):
    gold, new = lines(spark, {"a": 1}, {"a": 2}), lines(spark, {"a": 1}).unionByName(lines(spark, {"z": 1}).withColumn("line", F.lit(9)))
    found = diff.diff_tables(gold, new, ["file", "line"])
    assert rows(found, "line", "problem") == [(1, "missing"), (9, "extra")]
    assert rows(diff.only_in_gold(gold, new, ["file", "line"])) == [("f", 1)]
    assert rows(diff.only_in_new(gold, new, ["file", "line"])) == [("f", 9)]


def test_delivery_rounds(spark, tmp_path):
    def answer(body: bytes, headers: dict) -> tuple:
        if b"boom" in body:
            raise OSError("no route")
        return (200, None) if b"ok" in body else (400, "bad")

    ledger = str(tmp_path / "ledger")
    bundles = spark.createDataFrame([("a", "ok"), ("b", "bad"), ("c", "boom")], "bundle_id string, payload string")
    first = delivery.deliver_pending(spark, bundles, ledger, answer)
    assert rows(first, "bundle_id", "outcome", "error_text") == [
        ("a", "done", None), ("b", "quarantined", "bad"), ("c", "retry", "no route"),
    ]
    second = delivery.deliver_pending(spark, bundles, ledger, answer)
    assert rows(second.groupBy("bundle_id").count()) == [("a", 1), ("b", 1), ("c", 2)]
    state = delivery.delivery_ledger(second, when="attempt_ts")
    assert rows(state, "bundle_id", "attempts", "outcome") == [("a", 1, "done"), ("b", 1, "quarantined"), ("c", 2, "retry")]


def test_empty_bundles_are_skipped_on_request(spark):
    bundles = spark.createDataFrame([("a", 0), ("b", 1)], "bundle_id string, n long")
    none = delivery.delivery_ledger(spark.createDataFrame([], "bundle_id string, status int, attempt_s long"))
    assert delivery.pending(bundles, none, n_bytes="n").count() == 2
    assert rows(delivery.pending(bundles, none, n_bytes="n", upload_empty=False), "bundle_id") == [("b",)]


def test_errors_are_counted_and_the_rest_goes_on(spark):
    data = [("{}", "application/json"), ("{", "application/json"), ("x", "text/plain")]
    df = spark.createDataFrame(data, "body string, content_type string").withColumn("exchange", F.lit("e"))
    rows_ = filters.parse_json_body(filters.dispatch_content_type(df))
    good, bad = filters.reject_errors(rows_)
    assert (good.count(), bad.count()) == (1, 2)
    assert rows(filters.error_counts(rows_)) == [("body is not a JSON object", 1), ("unknown content type", 1)]


def test_observed_throughput(spark):
    df = spark.createDataFrame([("abc", "xy", None), ("d", None, "bad")], "body string, value string, error string")
    assert tuple(stats.throughput_stats(df).first()) == (2, 4, 1, 2, 1)


def test_dry_run_writes_nothing(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "value string").withColumn("ingest_ts", F.current_timestamp())
    assert sinks.write_daily(df, str(tmp_path / "d"), dry_run=True).count() == 1
    assert not (tmp_path / "d").exists()
