"""What a row costs: lambdas, patterns and methods the JVM compiles."""

import re

from pyspark.sql import functions as F

from sparkevents.functions import numbers
from sparkevents.functions import variants as V
from sparkevents.operators import encode, filters, hits
from sparkevents.plans import catalogue

LIMIT = "spark.sql.codegen.hugeMethodLimit"
DOCS = '{"docs":[{"n":1,"md5":"%s"},{"n":2,"ioc_attr":"{\\"direction\\":\\"inbound\\",\\"local_port\\":1.10}"}],"server_name":"s"}' % ("a" * 32)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def parsed(spark, *bodies):
    df = spark.createDataFrame([("feed.7.storage.hit", b) for b in bodies], "routing_key string, body string")
    return filters.parse_json_body(df)


def test_values_are_not_computed_inside_of_lambdas(spark):
    for df in (hits.normalize_hits(parsed(spark, DOCS), "srv", "https://c"), encode.leef_net_fields(parsed(spark, DOCS))):
        lambdas = [line for line in plan(df).splitlines() if re.search(r"map_filter\(map\(|transform\(array\(map_filter", line)]
        assert lambdas == []


def test_a_row_of_a_document_does_not_carry_the_others(spark):
    rows = plan(hits.explode_docs(parsed(spark, DOCS)))
    generate = next(line for line in rows.splitlines() if "posexplode" in line)
    below = rows[rows.index(generate) :].splitlines()[1]
    assert "map_filter(msg" in below  # the documents are taken out before the message is repeated


def test_documents_and_network_fields(spark):
    rows = hits.normalize_hits(parsed(spark, DOCS, '{"docs":[]}', '{"docs":7}', '{"a":1}'), "srv", "https://c")
    found = encode.encode_leef(rows).select("doc_pos", "value", "error").collect()
    lines = {r["doc_pos"]: r["value"] for r in found if r["doc_pos"] is not None}
    assert "md5=" + "A" * 32 in lines[0].split("\t") and "link_md5=https://c/#/binary/" + "A" * 32 in lines[0].split("\t")
    assert "srcPort=" not in lines[1] and "dstPort=1.10" in lines[1].split("\t") and "n=2" in lines[1].split("\t")
    assert sorted(str(r["error"]) for r in found) == ["None", "None", "None", "docs is not an array"]


def test_only_bodies_with_such_numbers_are_searched_for_them(spark):
    df = spark.createDataFrame([('{"md5":"5e3a-0b","v":"x1.10"}',), ('{"a":1e3}',), ('{"a":[ 1.10]}',), ('{"a":{"b":\n-0}}',)], "body string")
    assert [r[0] for r in df.select(F.col("body").rlike(numbers._HINT)).collect()] == [False, True, True, True]


def test_text_of_strings(spark):
    m, mark = F.col("msg"), numbers.MARK
    df = parsed(spark, '{"a":"x","b":1.10,"c":2,"d":null,"e":["x"],"f":"%s1"}' % mark)
    row = df.select(*[V.string_value(m[k]) for k in "abcdefg"]).first()
    assert list(row) == ["x", None, None, None, None, f"{mark}1", None]


def test_methods_too_long_for_the_jvm_are_not_used(spark):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        catalogue.callables()["subscribe_filter"](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(LIMIT)) <= 8000
    finally:
        spark.conf.set(LIMIT, before)
