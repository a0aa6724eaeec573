"""Known answers of the scalar rules and of whole messages."""

import ipaddress
import json
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sparkevents.functions import scalars as S
from sparkevents.functions import variants as V
from sparkevents.operators import encode, filters, hits, sensor
from sparkevents.sources.sensor_schema import spark_type


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_known_answers(spark):
    lit = F.lit
    assert one(spark, S.make_guid(lit(7), lit(4052), lit(131000000000000000))) == "00000007-0000-0fd4-01d1-67ce51938000"
    assert one(spark, S.make_guid(lit(-1), lit(-2), lit(-3))) == "ffffffff-ffff-fffe-ffff-fffffffffffd"
    assert one(spark, S.unix_seconds(lit(131000000000000000))) == 1455526400
    assert one(spark, S.unix_seconds_float(lit(131000000005000000))) == 1455526400.5
    assert one(spark, S.unix_seconds(lit(0))) == 0
    assert one(spark, S.ipv4_big_endian(lit(-1062731514))) == "192.168.1.6"
    assert one(spark, S.ipv4_little_endian(lit(0x0100007F))) == "127.0.0.1"
    assert one(spark, S.ntohs(lit(47873))) == 443
    assert one(spark, hits.hit_type(lit("feed.12.storage.hit.process"))) == "feed.storage.hit.process"
    assert one(spark, hits.hit_type(lit("feed.x.storage.hit"))) == "feed.x.storage.hit"
    assert one(spark, S.upper(lit("straße é a"))) == "STRASSE É A"
    assert one(spark, S.is_gzip(lit(b"\x1f\x8b\x08\x00"))) and not one(spark, S.is_gzip(lit(b"PK")))


@pytest.mark.parametrize(
    ("text", "as_base64", "expected"),
    [("zwölf Töne", True, "enfDtmxmIFTDtm5l"), ("a b\n", False, "a b\n"), ("", True, ""), ("\x00", True, "AA==")],
)
def test_event_text(spark, text, as_base64, expected):
    assert one(spark, S.event_text(F.lit(text), as_base64)) == expected


def test_long_base64_has_no_line_breaks(spark):
    assert "\n" not in one(spark, S.event_text(F.lit("x" * 500), True))


def test_ipv6_against_the_standard_library(spark):
    rnd = random.Random(3)
    expected, data = [], []
    for i in range(800):
        groups = [rnd.choice([0, 0, 0, 1, 0xFFFF, 0x10, 0xABCD]) for _ in range(8)]
        if i % 10 == 0:
            groups = [0] * 5 + [0xFFFF, rnd.randrange(65536), rnd.randrange(65536)]
        raw = b"".join(struct.pack(">H", g) for g in groups)
        high, low = struct.unpack("<QQ", raw)
        address = ipaddress.IPv6Address(raw)
        expected.append(str(address.ipv4_mapped or address.compressed))
        data.append((i, Decimal(high), Decimal(low)))
    df = spark.createDataFrame(data, "i int, high decimal(20,0), low decimal(20,0)")
    shown = df.select("i", S.ipv6_text(F.col("high"), F.col("low"), F.lit(None).cast("string")).alias("x"))
    assert [r["x"] for r in shown.orderBy("i").collect()] == expected


@pytest.mark.parametrize(
    ("text", "guid", "segment", "ok"),
    [
        ("short", "short", "1", False),
        ("0" * 36, "0" * 36, "1", True),
        ("0" * 36 + "-0000001f", "0" * 36, "31", True),
        ("0" * 36 + "-0000001g", "0" * 36, "1", False),
        ("0" * 36 + "-00000000001f", "0" * 36, "31", True),
        ("0" * 36 + "-00000000001g", "0" * 36, "0", False),
        ("0" * 40, "0" * 36, "1", False),
    ],
)
def test_full_guid(spark, text, guid, segment, ok):
    g, s, good = hits.full_guid(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(g, s, good).first()
    assert tuple(row) == (guid, segment, ok)


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("q=a%20b+c&rows=10", "a b c"),
        ("rows=10&q=first&q=second", "first"),
        ("%71=x", "x"),
        ("q", ""),
        ("q=a=b", "a=b"),
        ("rows=1", None),
        ("q=x&rows=%zz", None),
        ("q=x;y", None),
        ("", None),
    ],
)
def test_first_query_value(spark, query, expected):
    df = spark.createDataFrame([(query,)], "q string")
    assert df.select(S.first_query_value(F.col("q"), "q")).first()[0] == expected


HIT = {
    "server_name": "front", "event_timestamp": 1700000123.25, "watchlist_id": 7, "highlights": [],
    "cb_version": "9.8.7", "watchlist_name": "odd shells",
    "docs": [{
        "process_md5": "ab" * 16, "parent_md5": "f" * 30, "sensor_id": 1,
        "unique_id": "00000001-0000-0abc-01da-111122223333-00000001",
        "parent_unique_id": "00000001-0000-0def-01da-444455556666-00000001", "hostname": "BOX-7",
        "comms_ip": -1062731514, "interface_ip": -1062731264, "segment_id": 1, "regmod_count": 3, "cb_version": 987,
        "group": ["Lab"], "highlights": ["y"],
    }],
}


def parsed(spark, *messages, key="watchlist.hit.test"):
    df = spark.createDataFrame([(json.dumps(m), key) for m in messages], "body string, routing_key string")
    return filters.parse_json_body(df).drop("error")


def test_watchlist_hit(spark):
    done = encode.encode_json(hits.normalize_hits(parsed(spark, HIT), "srv", "https://c.example.org")).collect()
    (event,) = [json.loads(r["value"]) for r in done]
    assert event["timestamp"] == 1700000123.25 and "event_timestamp" not in event and "highlights" not in event
    assert (event["type"], event["cb_server"]) == ("watchlist.hit.test", "srv")
    (doc,) = event["docs"]
    assert doc["process_guid"] == "00000001-0000-0abc-01da-111122223333" and doc["segment_id"] == "1"
    assert doc["parent_guid"] == "00000001-0000-0def-01da-444455556666" and doc["parent_segment_id"] == "1"
    assert doc["process_md5"] == "ABABABABABABABABABABABABABABABAB" and doc["parent_md5"] == "f" * 30
    assert "link_parent_md5" not in doc and doc["link_process_md5"].endswith("#/binary/ABABABABABABABABABABABABABABABAB")
    assert (doc["comms_ip"], doc["interface_ip"]) == ("192.168.1.6", "192.168.2.0")
    assert doc["computer_name"] == doc["hostname"] == "BOX-7" and "highlights" not in doc
    assert doc["link_process"] == "https://c.example.org/#analyze/00000001-0000-0abc-01da-111122223333/1"
    assert doc["link_sensor"] == "https://c.example.org/#/host/1"


def test_two_docs_give_two_events_and_none_gives_none(spark):
    two = {**HIT, "docs": [{"a": 1}, {"a": 2}]}
    out = hits.normalize_hits(parsed(spark, two, {**HIT, "docs": []}, {"x": 1}), "srv")
    docs = [json.loads(r["value"]).get("docs") for r in encode.encode_json(out).collect()]
    assert sorted(docs, key=str) == [None, [{"a": 1}], [{"a": 2}]] or sorted(docs, key=str) == [[{"a": 1}], [{"a": 2}], None]


def test_alert_ignores_unique_id_and_falls_back(spark):
    m = {"unique_id": "0" * 36, "process_id": "short"}
    out = hits.process_guid_segment(parsed(spark, m, key="alert.x")).select(F.col("msg")["process_guid"].cast("string"))
    assert out.first()[0] == "short"


def test_drop_keys(spark):
    out = hits.drop_keys(parsed(spark, {"a": 1, "b": 2, "highlights": 3}), [" a "])
    assert out.select(F.map_keys("msg")).first()[0] == ["b"]


def test_normalize_can_drop_keys(spark):
    out = hits.normalize_hits(parsed(spark, HIT), "srv", drop=("watchlist_id", "computer_name"))
    event = json.loads(encode.encode_json(out).first()["value"])
    assert "watchlist_id" not in event and "computer_name" not in event["docs"][0]


# ---- LEEF ------------------------------------------------------------------------------------------------------------


def leef(spark, message, **style):
    df = spark.createDataFrame([(json.dumps(message),)], "body string")
    return encode.encode_leef(df.select(F.from_json("body", V.MESSAGE).alias("msg")), **style).first()


def test_leef_promotes_the_document(spark):
    line = leef(spark, HIT)["value"]
    head, _, _ = line.partition("cb_version")
    assert head == "LEEF:1.0|CB|CB|987|unknown.event.type|"
    assert "\tgroup=[Lab]\t" in line and "\thighlights=[y]\t" in line


def test_leef_escapes_and_values(spark):
    line = leef(spark, {"type": "ingress.event.procstart", "a": "x=\t\n\r\\", "b": None, "c": {}, "d": {"k": 1}, "e": True,
                        "f": [], "g": [1, "z", None, {"q": 1}], "n": 1.5})["value"]
    assert line == (
        "LEEF:1.0|CB|CB|5.1|ingress.event.process|a=x\\=\\t\\n\\r\\\\\tc=\td={\"k\":1}\te=true\tf=[]\t"
        "g=[1 z <nil> map[q:1]]\tn=1.5\ttype=ingress.event.procstart"
    )


def test_leef_json_lists(spark):
    assert leef(spark, {"g": [1, "z"]}, list_style="json")["value"].endswith('|g=[1,"z"]')


def test_leef_network_fields(spark):
    ends = {"local_ip": "1.1.1.1", "remote_ip": "2.2.2.2", "local_port": 1, "remote_port": 2, "protocol": 6}
    line = leef(spark, {"type": "ingress.event.netconn", "direction": "inbound", **ends})["value"]
    assert "\tsrc=2.2.2.2\tsrcPort=2\t" in line and "\tdst=1.1.1.1\tdstPort=1\t" in line and "\tproto=6\t" in line
    line = leef(spark, {"ioc_attr": json.dumps(ends)})["value"]
    assert "\tsrc=1.1.1.1\t" in line


@pytest.mark.parametrize("message", [{"docs": []}, {"docs": [{}, {}]}, {"docs": 1}, {"ioc_attr": "{bad"}])
def test_leef_errors(spark, message):
    row = leef(spark, message)
    assert row["value"] is None and row["error"]


def test_audit_json(spark):
    df = spark.createDataFrame([('say "hi"', "audit.log.banning")], "message string, type string")
    assert json.loads(encode.audit_json(df, "srv").first()["value"]) == {
        "message": 'say "hi"', "type": "audit.log.banning", "cb_server": "srv",
    }


# ---- subscriptions ---------------------------------------------------------------------------------------------------


def test_parse_subscriptions():
    assert filters.parse_subscriptions({"events_raw_sensor": "ALL"}) == filters.SUBSCRIPTION_GROUPS["events_raw_sensor"]
    assert filters.parse_subscriptions({"events_raw_sensor": "Ingress.Event.Regmod"}) == ["ingress.event.regmod"]
    assert filters.parse_subscriptions({"events_raw_sensor": "0"}) == []
    assert filters.parse_subscriptions({"events_feed": "a,b"}) == ["a", "b"]


CASES = {
    "watchlist.#": (["watchlist", "watchlist.a", "watchlist.a.b"], ["watchlists.a", "x.watchlist"]),
    "feed.*.hit": (["feed.1.hit"], ["feed.hit", "feed.1.2.hit"]),
    "#.hit": (["hit", "a.hit", "a.b.hit"], ["ahit", "hit.a"]),
    "#": (["a", "a.b"], []),
    "a.#.z": (["a.z", "a.b.z", "a.b.c.z"], ["az", "a.zz"]),
    "*.b": (["a.b"], ["b", "a.a.b"]),
    "a+b": (["a+b"], ["aab"]),
}


@pytest.mark.parametrize("pattern", CASES)
def test_topic_patterns(spark, pattern):
    yes, no = CASES[pattern]
    df = spark.createDataFrame([(k,) for k in yes + no], "routing_key string")
    assert rows(filters.subscribe_filter(df, [pattern])) == sorted((k,) for k in yes)
    joined = filters.subscribe_join(df, filters.pattern_table(spark, [pattern, "never.matches"]))
    assert rows(joined) == sorted((k,) for k in yes)


# ---- sensor ----------------------------------------------------------------------------------------------------------


def sensor_message(spark, **parts):
    schema = spark_type()
    names = [f.name for f in schema]
    row = {"header": {"version": 4, "timestamp": 131000000000000000}, **parts}
    df = spark.createDataFrame([tuple(row.get(n) for n in names)], schema)
    return df.withColumn("headers", F.create_map(F.lit("sensorHostName"), F.lit("bob"), F.lit("sensorId"), F.lit("1")))


ALL = [sensor.PREFIX + t for _, _, types in sensor.FAMILIES.values() for t in types]


def event(df, **options):
    row = sensor.normalize_sensor(df, options.pop("enabled", ALL), **options).first()
    return json.loads(row["value"]) if row else None


def test_minimal_process(spark):
    e = event(sensor_message(spark, process={"parent_create_time": 131000000000000000}))
    assert e["timestamp"] == e["parent_create_time"] == 1455526400
    assert (e["sensor_id"], e["computer_name"], e["type"]) == (1, "bob", "ingress.event.procend")
    assert e["process_guid"] == "0" and "pid" not in e and "cb_server" not in e and "link_process" not in e


def test_absent_enums_read_as_their_first_value(spark):
    assert event(sensor_message(spark, filemod={"tamper": False}))["action"] == "create"
    assert event(sensor_message(spark, networkv2={"localPort": 47873}))["protocol"] == 6
    assert event(sensor_message(spark, regmod={"action": 3}))["action"] == "unknown (3)"
    assert event(sensor_message(spark, networkv2={"localPort": 47873}))["local_port"] == 443
    assert event(sensor_message(spark, networkv2={"localPort": 47873}))["remote_ip"] == "0.0.0.0"


def test_blocked_netconn_hides_a_tamper_alert(spark):
    both = sensor_message(spark, netconnBlocked={"port": 1}, tamperAlert={"type": 1})
    assert event(both) is None
    assert event(sensor_message(spark, tamperAlert={"type": 1}))["tamper_type"] == "CoreDriverUnloaded"


def test_literal_names(spark):
    e = event(sensor_message(spark, regmod={"tamper": True}), strict_reference_names=True)
    assert (e["tamper_sent"], e["tamper"]) == (True, False)
    e = event(sensor_message(spark, networkv2={"localPort": 1}), strict_reference_names=True)
    assert e["Protocol"] == 6


def test_float_time_and_links(spark):
    o = sensor.Options("srv", "https://c", True)
    e = event(sensor_message(spark, scriptexe={"script": "x"}), o=o)
    assert e["timestamp"] == 1455526400.0 and e["link_sensor"] == "https://c/#/host/1" and e["cb_server"] == "srv"


def test_bad_header_is_an_error_row(spark):
    df = sensor_message(spark, regmod={"action": 1}).withColumn("headers", F.create_map(F.lit("sensorId"), F.lit("x")))
    assert sensor.fill_env(df).first()["error"] == "bad header sensorId"


def test_first_string_wins(spark):
    strings = [{"guid": 5, "utf8string": b"one"}, {"guid": 5, "utf8string": b"two"}]
    header = {"version": 4, "filepath_string_guid": 5}
    assert event(sensor_message(spark, header=header, strings=strings, modload={"guid": 1}))["path"] == "one"
    assert event(sensor_message(spark, header={"version": 4, "filepath_string_guid": 6}, strings=strings, modload={"guid": 1}))["path"] == ""


def test_legacy_process_exit(spark):
    e = event(sensor_message(spark, process={"pid": 1}), naming="legacy")
    assert e["md5"] == "" and e["pid"] == 0 and e["parent_process_guid"] == "0"
    assert event(sensor_message(spark, process={"pid": 1}), enabled=["ingress.event.procstart"], strict_procend=True) is None
