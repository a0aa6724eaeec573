"""Payloads in a Python worker."""

from sparkevents.operators import delivery


def test_payloads_become_objects_one_at_a_time(spark):
    df = spark.createDataFrame([("a", "é" * 5, None), ("b", "x", b"\x00\x01")], "bundle_id string, payload string, raw binary")
    sent = delivery.deliver(df, lambda body, headers: (200, str(len(body))))
    assert "MapInArrow" in sent._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["bundle_id"], r["status"], r["error_text"], r["outcome"]) for r in sent.orderBy("bundle_id").collect()] == [
        ("a", 200, "10", "done"), ("b", 200, "1", "done")
    ]
    raw = delivery.deliver(df.filter("raw IS NOT NULL"), lambda body, headers: (200, body.hex()), payload="raw").first()
    assert raw["error_text"] == "0001" and raw["attempt_ts"] is not None
    assert delivery.deliver(df.limit(0), lambda body, headers: (200, None)).count() == 0
