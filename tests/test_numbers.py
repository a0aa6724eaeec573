"""Number text through parsing and printing, strings that look like kept numbers, and values at any depth."""

import json

from pyspark.sql import functions as F

from sparkevents.functions import numbers
from sparkevents.functions import variants as V
from sparkevents.operators import encode, filters, hits

M = numbers.MARK


def printed(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    found = encode.encode_json(filters.parse_json_body(df)).orderBy("i").collect()
    return [r["value"] if r["error"] is None else None for r in found]


def test_numbers_come_out_as_they_came(spark):
    texts = ["1.10", "1e3", "-0", "-0.0", "7" * 30, "7" * 44, "1.5E+400", "0.10", "12", "-3.25", "0", "1E-2", "9" * 19 + ".5"]
    bodies = ['{"a":%s,"l":[%s,[%s]],"o":{"p":%s}}' % (t, t, t, t) for t in texts]
    assert printed(spark, bodies) == bodies
    strings = ['{"s":"1.10, 1e3"}', r'{"s":"a\"1.10\",\"1e3"}', r'{"s":"\\\\","t":1.10}', '{"1.10":"-0","b":1e2}', '{"s":"x","t":["1e3",1e3]}']
    assert printed(spark, strings) == strings
    assert printed(spark, ["{ \"a\" : 1.10 ,\n\"b\":[ 2.0\t] }"]) == ['{"a":1.10,"b":[2.0]}']


def test_what_is_no_json_stays_none(spark):
    bad = ['{"a":01.10}', '{"a":1.10.5}', '{"a":1e}', '{"a":nul1.10}', '{"a":1.10', '{"a":"x}', '[1.10]', "1.10", '{"a":+1e3}', '{"a":1.}', ""]
    assert printed(spark, bad) == [None] * len(bad)


def test_strings_that_begin_with_the_mark(spark):
    bodies = [f'{{"s":"{M}1.10"}}', f'{{"s":"{M}{M}x","t":1.10}}', f'{{"s":["a","{M}12",1e3]}}', f'{{"s":"a\\"{M}12"}}', f'{{"s":"{M}"}}']
    assert printed(spark, bodies) == bodies
    assert printed(spark, ['{"s":"\\uE0001e3","t":2e2}']) == [f'{{"s":"{M}1e3","t":2e2}}']
    df = spark.createDataFrame([(f'{{"s":"{M}1.10","n":1.10}}',)], "body string")
    m = F.col("msg")
    got = filters.parse_json_body(df).select(V.string_value(m["s"]), V.string_value(m["n"]), numbers.text(m["n"])).first()
    assert tuple(got) == (f"{M}1.10", None, "1.10")


def test_long_bodies(spark):
    body = json.dumps({"l": ["a\\\"" * 3, 1.5] * 60_000, "s": "\\n" * 200_000}, separators=(",", ":"))[:-1] + ',"t":1.10}'
    assert printed(spark, [body]) == [body]


def test_rules_see_no_strings_in_numbers(spark):
    body = '{"comms_ip":1e3,"md5":1.10,"hostname":2.0,"event_timestamp":1447724404.340}'
    df = spark.createDataFrame([("watchlist.hit", body)], "routing_key string, body string")
    out = encode.encode_json(hits.normalize_hits(filters.parse_json_body(df), "srv", "https://c.example.org")).first()["value"]
    for part in ('"comms_ip":1e3', '"md5":1.10', '"computer_name":2.0', '"timestamp":1447724404.340'):
        assert part in out


def test_values_at_any_depth(spark):
    def leef(body):
        df = spark.createDataFrame([(body,)], "body string")
        return encode.encode_leef(filters.parse_json_body(df)).first()["value"].split("|")[-1]

    assert leef('{"a":[[[1,2]]]}') == "a=[[[1 2]]]"
    deep = "[" * 40 + "1.10" + "]" * 40
    assert leef(f'{{"a":{deep}}}') == f"a={deep}"
    assert leef('{"a":[{"z":{"y":[null,true,"q r"]},"b":-0.0},"s"]}') == "a=[map[b:-0.0 z:map[y:[<nil> true q r]]] s]"
    assert leef(r'{"a":["q\"u,[","\\","é\n",{"k,:\"":[]}]}') == 'a=[q"u,[ \\ é\n map[k,:":[]]]'
    assert leef('{"a":[],"b":{},"c":{"d":1.10},"e":1e3}') == 'a=[]\tb=\tc={"d":1.10}\te=1e3'
