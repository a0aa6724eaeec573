"""Carrier views: the given tables re-shaped into the messages the operators expect.

The driver tables hold no security events, so every catalogue query first derives reference-shaped input from them.
Each carrier is one SELECT that reads the same in Spark and DuckDB; the few functions whose names differ go through
``Dialect``. ``cte`` returns the text for the oracle, ``view`` the DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.structs import fit
from ..sources.envelope import spread
from ..sources.sensor_schema import spark_type


class Spark:
    us = "unix_micros(cast(ts as timestamp))"
    order_us = "unix_micros(cast(o_orderdate as timestamp))"
    lines = "explode(split(text, chr(10)))"
    in_order = staticmethod(lambda x, by: f"listagg({x}, ',') WITHIN GROUP (ORDER BY {by})")
    md5 = staticmethod(lambda x: f"md5({x})")
    sha256 = staticmethod(lambda x: f"sha2({x}, 256)")
    div = staticmethod(lambda a, b: f"({a} div {b})")
    shr = staticmethod(lambda a, n: f"shiftright({a}, {n})")
    lam = staticmethod(lambda v, body: f"{v} -> {body}")
    each = "transform"
    join = "array_join"


class Duck:
    us = "epoch_us(ts)"
    order_us = "epoch_us(o_orderdate)"
    lines = "unnest(string_split(text, chr(10)))"
    in_order = staticmethod(lambda x, by: f"string_agg({x}, ',' ORDER BY {by})")
    md5 = staticmethod(lambda x: f"md5({x})")
    sha256 = staticmethod(lambda x: f"sha256({x})")
    div = staticmethod(lambda a, b: f"({a} // {b})")
    shr = staticmethod(lambda a, n: f"({a} >> {n})")
    lam = staticmethod(lambda v, body: f"lambda {v}: {body}")
    each = "list_transform"
    join = "array_to_string"


Dialect = type[Spark] | type[Duck]

RAW_EXCHANGE = "api.rawsensordata"


def _clock(d: Dialect) -> str:
    """Events with their clock as microseconds, ticks since 1601 and whole seconds."""
    return f"""
    SELECT event_id, user_id, event_type, value, us,
           us * 10 + 116444736000000000 AS win, {d.div("us", 1000000)} AS secs
    FROM (SELECT event_id, user_id, event_type, value, {d.us} AS us FROM events) AS e0"""


def guid_sql(d: Dialect, sensor: str, pid: str, ct: str) -> str:
    """Identifier text of sensor id, pid and create time, written out in SQL."""
    masked = [
        f"({sensor}) & 4294967295",
        f"{d.shr(pid, 16)} & 65535",
        f"({pid}) & 65535",
        f"{d.shr(ct, 48)} & 65535",
        f"{d.shr(ct, 32)} & 65535",
        f"({ct}) & 4294967295",
    ]
    return "printf('%08x-%04x-%04x-%04x-%04x%08x', " + ", ".join(f"cast({m} as bigint)" for m in masked) + ")"


def bus_hits(d: Dialect) -> str:
    """One JSON hit per event: identifiers of every length, hashes, addresses, indicators and docs-free bodies."""
    t = lambda x: f"cast({x} as string)"
    pick = lambda cond, text: f"CASE WHEN {cond} THEN {text} ELSE '' END"
    body = " || ".join(
        [
            "'{\"event_timestamp\":'", t("secs"), "',\"hostname\":\"h'", t("user_id"), "'\",\"sensor_id\":'", t("user_id"),
            "',\"md5\":\"'", "md5", "'\",\"process_md5\":\"'", d.md5(t("user_id")), "'\"'",
            "',\"comms_ip\":'", t("comms_ip"), "',\"interface_ip\":'",
            f"CASE WHEN event_id % 6 = 0 THEN '\"10.0.0.1\"' ELSE {t('comms_ip + 3000000000 * (event_id % 2)')} END",
            pick("event_id % 10 <> 9", "',\"unique_id\":\"' || unique_id || '\"'"),
            pick("event_id % 3 = 0", "',\"process_id\":\"' || substr(unique_id, 1, 36 - cast(event_id % 2 as int) * 6) || '\"'"),
            pick("event_id % 2 = 0", "',\"parent_unique_id\":\"' || unique_id || '\"'"),
            pick("event_id % 4 = 1", "',\"parent_md5\":\"' || substr(md5, 1, 30) || '\"'"),
            pick("event_id % 5 = 1", "',\"ioc_type\":{\"md5\":\"' || substr(md5, 1, 8) || '\",\"n\":' || " + t("user_id") + " || '}'"),
            pick("event_id % 5 = 2", "',\"ioc_type\":\"md5\"'"),
            pick("event_id % 7 = 3", "',\"ioc_attr\":{\"direction\":\"' || CASE WHEN event_id % 2 = 0 THEN 'inbound' ELSE 'outbound' END"
                 " || '\",\"local_ip\":\"10.1.2.3\",\"local_port\":' || " + t("user_id")
                 + " || ',\"protocol\":6,\"remote_ip\":\"10.9.8.7\",\"remote_port\":443}'"),
            pick("event_id % 3 = 1", "',\"cb_version\":' || CASE WHEN event_id % 2 = 0 THEN '510' ELSE '\"5.1.0\"' END"),
            pick("event_id % 8 = 4", "',\"note\":\"a=b' || chr(92) || 'tc' || chr(92) || chr(92) || 'd\",\"nothing\":null,\"flag\":true,\"tags\":[\"x\",2,null],\"empty\":{}'"),
            "',\"highlights\":[\"x\"]}'",
        ]
    )
    return f"""
    SELECT event_id, user_id, event_type, us, win, secs, routing_key, guid, unique_id, md5, comms_ip,
           CASE WHEN event_id % 10 = 3 THEN '{RAW_EXCHANGE}' ELSE 'api.events' END AS exchange,
           'application/json' AS content_type, {body} AS body
    FROM (
      SELECT *, guid || CASE event_id % 4 WHEN 0 THEN ''
                  WHEN 1 THEN '-' || printf('%08x', cast(event_id % 255 as bigint))
                  WHEN 2 THEN '-' || printf('%012x', cast(event_id as bigint)) ELSE '-zz' END AS unique_id
      FROM (
        SELECT *, {guid_sql(d, "user_id", "event_id", "win")} AS guid,
               substr({d.md5("cast(event_id as string)")}, 1, CASE WHEN event_id % 5 = 0 THEN 30 ELSE 32 END) AS md5,
               cast((event_id * 7919) % 4294967296 - 2147483648 as bigint) AS comms_ip,
               CASE event_type
                 WHEN 'click' THEN 'watchlist.' || cast(user_id % 20 as string) || '.hit.process'
                 WHEN 'view' THEN 'feed.' || cast(user_id % 20 as string) || '.storage.hit.process'
                 WHEN 'error' THEN 'alert.watchlist.hit.query.process'
                 WHEN 'purchase' THEN 'binaryinfo.host.observed'
                 ELSE 'task.error.logged' END AS routing_key
        FROM ({_clock(d)}) AS e1) AS e2) AS e3"""


def bus_bad(d: Dialect) -> str:
    """Hits of which some have a truncated body, an array body or an unknown content type."""
    return f"""
    SELECT event_id, user_id, us, routing_key, exchange,
           CASE WHEN event_id % 89 = 0 THEN 'text/plain'
                WHEN event_id % 83 = 0 THEN 'application/zip'
                WHEN event_id % 79 = 0 THEN 'application/protobuf'
                ELSE content_type END AS content_type,
           CASE WHEN event_id % 97 = 0 THEN substr(body, 1, 40)
                WHEN event_id % 101 = 0 THEN '[1]'
                WHEN event_id % 103 = 0 THEN '' ELSE body END AS body
    FROM bus_hits"""


def hit_docs(d: Dialect) -> str:
    """One hit per order with a sub-document per line item; orders without items have an empty ``docs``, every tenth order
    has none at all."""
    doc = (
        "'{\"n\":' || cast(l_linenumber as string) || ',\"hostname\":\"h' || cast(l_suppkey as string) || '\",\"md5\":\"' || "
        + d.md5("cast(l_partkey as string)")
        + " || '\",\"comms_ip\":' || cast(l_orderkey * l_linenumber as string) || ',\"cb_version\":'"
        " || cast(500 + l_linenumber as string)"
        " || ',\"unique_id\":\"' || printf('%08x-0000-0000-0000-000000000001', cast(l_suppkey as bigint)) || '\"}'"
    )
    return f"""
    SELECT o_orderkey, o_custkey, cast(CASE WHEN o_orderkey % 10 = 3 THEN -1 ELSE coalesce(n, 0) END as bigint) AS n_docs,
           CASE WHEN o_orderkey % 4 = 0 THEN 'feed.7.storage.hit.process' ELSE 'watchlist.hit.process' END AS routing_key,
           '{{"event_timestamp":' || cast({d.div(d.order_us, 1000000)} as string) || ',"server_name":"s' ||
           o_orderstatus || '","cb_version":"5.1"' || CASE WHEN o_orderkey % 10 = 3 THEN '' ELSE ',"docs":[' ||
           coalesce(docs, '') || ']' END || '}}' AS body
    FROM orders LEFT JOIN (
      SELECT l_orderkey, count(*) AS n, {d.in_order("doc", "l_linenumber, doc")} AS docs
      FROM (SELECT l_orderkey, l_linenumber, {doc} AS doc FROM lineitem) AS l0 GROUP BY l_orderkey
    ) AS l1 ON o_orderkey = l_orderkey"""


def ioc_urls(d: Dialect) -> str:
    """One query-type indicator per page, built from the page's url; some of them malformed."""
    query = (
        f"CASE page_id % 6 WHEN 0 THEN 'q=' || replace(url, '/', '%2F') || '&rows=10' "
        f"WHEN 1 THEN 'rows=10&q=' || url || '+x&q=second' "
        f"WHEN 2 THEN 'rows=' || url WHEN 3 THEN 'q=' || url || '%zz' "
        f"WHEN 4 THEN 'rows=%2&q=' || url ELSE url || '&q' END"
    )
    member = (
        "CASE WHEN page_id % 11 = 0 THEN '' ELSE '\"index_type\":\"events\",' END || "
        "CASE WHEN page_id % 13 = 0 THEN '\"n\":1,' ELSE '' END"
    )
    return f"""
    SELECT page_id, search_query, 'feed.3.query.hit.process' AS routing_key,
           '{{"ioc_type":"' || CASE WHEN page_id % 17 = 0 THEN 'md5' ELSE 'query' END || '","ioc_value":"{{' ||
           replace({member} || '"search_query":"' || search_query || '"', '"', chr(92) || '"') || '}}"}}' AS body
    FROM (SELECT page_id, {query} AS search_query FROM pages) AS p0"""


def sensor_flat(d: Dialect) -> str:
    """Inputs of one sensor message per event as plain columns; ``sensor_events`` nests them for Spark."""
    t = lambda x: f"cast({x} as string)"
    return f"""
    SELECT event_id, user_id, win, us, cast(event_id % 16 as int) AS fam, cast(event_id % 32 as int) AS fam32,
           CASE WHEN event_id % 50 = 0 THEN 0 ELSE win END AS h_ts,
           event_id * 1000003 AS h_guid,
           event_id % 2500 AS h_path_guid,
           CASE WHEN event_id % 7 = 0 THEN NULL ELSE win - user_id END AS h_ct,
           CASE WHEN event_id % 11 = 0 THEN NULL ELSE (event_id * 37) % 1000000007 END AS h_pid,
           CASE WHEN event_id % 5 = 0 THEN NULL ELSE {d.md5(t("event_id"))} END AS h_md5,
           CASE WHEN event_id % 5 = 1 THEN NULL ELSE {d.sha256(t("event_id"))} END AS h_sha,
           CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'c:/p/' || {t("user_id")} END AS h_path,
           CASE WHEN event_id % 4 = 0 THEN user_id END AS h_fork,
           CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'C:/windows/' || {t("event_id % 2500")} || '.exe' END AS path,
           CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS sensor,
           'host-' || {t("user_id")} AS host,
           event_id % 3 = 0 AS env_from_headers,
           {d.md5(t("user_id"))} AS own_md5, {d.sha256(t("user_id"))} AS own_sha,
           event_id % 8 >= 4 AS has_own,
           cast(event_id % 20 as int) AS small,
           event_id % 2 = 0 AS even,
           (event_id * 2654435761) % 4294967296 AS ip_a, (event_id * 40503 + 7) % 4294967296 AS ip_b,
           (event_id * 31) % 65536 AS port_a, (event_id * 17 + 5) % 65536 AS port_b,
           'text ' || {t("event_id")} AS text
    FROM ({_clock(d)}) AS e1"""


def string_table(d: Dialect) -> str:
    """Side table of strings, with a second entry per tenth id that must lose to the first."""
    return """
    SELECT p_partkey AS guid, p_name AS utf8string, 0 AS pos FROM part
    UNION ALL SELECT p_partkey AS guid, 'later ' || p_name AS utf8string, 1 AS pos FROM part WHERE p_partkey % 10 = 0"""


def ips(d: Dialect) -> str:
    return """
    SELECT c_custkey, (c_custkey * 2654435761) % 4294967296 AS v4,
           (c_custkey * 31) % 65536 AS port, c_custkey % 7 AS shape FROM customer"""


def messages(d: Dialect) -> str:
    """One text record per document, on one line."""
    return "SELECT doc_id, source, lang, replace(replace(text, chr(13), ' '), chr(10), ' ') AS value FROM documents"


def exact_hits(d: Dialect) -> str:
    """One hit per order with numbers that no parsed form prints as they came, and lists and objects up to 12 levels deep.

    Keys are in byte order and without blanks; ``deep_leef`` is the text of the nested value in LEEF."""
    t = lambda x: f"cast({x} as string)"
    depth, pairs = "cast(o_orderkey % 13 as int)", "cast(o_orderkey % 5 as int)"
    return f"""
    SELECT o_orderkey, ends, power, digits, point, o_orderpriority,
           repeat('[', {depth}) || '1,' || ends || ',null' || repeat(']', {depth}) AS inner_json,
           repeat('[', {depth}) || '1 ' || ends || ' <nil>' || repeat(']', {depth}) AS inner_leef,
           repeat('{{"k":[', {pairs}) || '"a, 1.50 b",' || power || repeat(']}}', {pairs}) AS pairs_json,
           repeat('map[k:[', {pairs}) || 'a, 1.50 b ' || power || repeat(']]', {pairs}) AS pairs_leef
    FROM (SELECT o_orderkey, o_orderpriority, {t("o_custkey")} || '.' || {t("o_orderkey % 10")} || '0' AS ends,
                 '-' || {t("o_custkey")} || CASE WHEN o_orderkey % 2 = 0 THEN 'e' ELSE '.5E+' END || {t("o_orderkey % 30")} AS power,
                 repeat({t("1 + o_orderkey % 9")}, cast(30 + o_orderkey % 15 as int)) AS digits,
                 CASE WHEN o_orderkey % 3 = 0 THEN '-0.0' ELSE '3.25' END AS point FROM orders) AS x0"""


EXACT_BODY = (
    "'{\"big\":' || digits || ',\"deep\":[' || inner_json || ',' || pairs_json || '],\"ends\":' || ends || ',\"like\":\"1.10,'"
    " || chr(92) || '\"2.50' || chr(92) || '\"\",\"o\":{\"p\":' || point || '},\"power\":' || power || ',\"who\":\"' || o_orderpriority || '\"}'"
)


def deliveries(d: Dialect) -> str:
    """One delivery attempt per order."""
    return f"""
    SELECT o_orderkey AS bundle_id, o_orderpriority AS dest,
           CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'P' THEN 400 ELSE 500 END AS status,
           CASE o_orderstatus WHEN 'F' THEN NULL ELSE 'refused ' || cast(o_custkey % 100 as string) END AS error_text,
           {d.div(d.order_us, 1000000)} AS attempt_s, o_custkey
    FROM orders"""


def two_outputs(d: Dialect) -> str:
    """Lines of a gold and a new output: changed, missing and extra values and lines at known places."""
    gold = (
        "'{\"key\":' || cast(o_orderkey as string) || ',\"price\":' || cast(o_custkey as string) || ',\"s\":\"' || "
        "o_orderstatus || '\",\"a\":[1,{\"z\":' || cast(o_custkey % 3 as string) || '}]}'"
    )
    new = (
        "'{\"price\":' || CASE WHEN o_orderkey % 7 = 0 THEN cast(o_custkey + 1 as string) WHEN o_orderkey % 19 = 0 THEN "
        "'\"' || cast(o_custkey as string) || '\"' ELSE cast(o_custkey as string) END || ',\"key\":' || cast(o_orderkey as string)"
        " || CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE ',\"s\":\"' || o_orderstatus || '\"' END || ',\"a\":[1' ||"
        " CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE ',{\"z\":' || cast(o_custkey % 3 as string) || '}' END || ']' ||"
        " CASE WHEN o_orderkey % 13 = 0 THEN ',\"extra\":true' ELSE '' END || '}'"
    )
    return f"""
    SELECT o_orderpriority AS file, o_orderkey AS line, o_custkey, o_orderstatus,
           {gold} AS gold, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {new} END AS new FROM orders"""


def audit_lines(d: Dialect) -> str:
    """Every line of every conversation text."""
    return f"""
    SELECT conv_id, turn, message,
           CASE turn % 4 WHEN 0 THEN 'live-response' WHEN 1 THEN 'banning' WHEN 2 THEN 'isolation'
                ELSE 'useractivity' END AS log
    FROM (SELECT conv_id, turn, {d.lines} AS message FROM conversations) AS c0"""


CARRIERS: dict[str, tuple[Callable[[Dialect], str], tuple[str, ...]]] = {
    # name: (SELECT builder, what it reads: driver tables or carriers listed above it)
    "bus_hits": (bus_hits, ("events",)),
    "bus_bad": (bus_bad, ("bus_hits",)),
    "hit_docs": (hit_docs, ("orders", "lineitem")),
    "ioc_urls": (ioc_urls, ("pages",)),
    "sensor_flat": (sensor_flat, ("events",)),
    "string_table": (string_table, ("part",)),
    "ips": (ips, ("customer",)),
    "messages": (messages, ("documents",)),
    "exact_hits": (exact_hits, ("orders",)),
    "deliveries": (deliveries, ("orders",)),
    "two_outputs": (two_outputs, ("orders",)),
    "audit_lines": (audit_lines, ("conversations",)),
}


def cte(*names: str) -> str:
    """``name AS (...)`` list for an oracle, with the carriers each name needs."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in CARRIERS and name not in done:
            for source in CARRIERS[name][1]:
                visit(source)
            done.append(name)

    for n in names:
        visit(n)
    return ",\n".join(f"{n} AS ({CARRIERS[n][0](Duck)})" for n in done)


#: Carriers that shuffle the rows of their tables by a key anyway, so only few splits are dealt out before.
SHUFFLED = ("hit_docs",)


def table(spark: SparkSession, sf_dir: str, name: str, by_rows: bool = True) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), by_rows)


def view(spark: SparkSession, sf_dir: str, name: str, by_rows: bool = True) -> DataFrame:
    """DataFrame of a carrier or of a driver table."""
    if name not in CARRIERS:
        return table(spark, sf_dir, name, by_rows)
    build, sources = CARRIERS[name]
    return from_frame(spark, build(Spark), {s: view(spark, sf_dir, s, name not in SHUFFLED) for s in sources})


def from_frame(spark: SparkSession, sql: str, sources: dict[str, DataFrame]) -> DataFrame:
    return spark.sql(_braced(sql, sources), **sources)


def _braced(sql: str, sources: dict[str, DataFrame]) -> str:
    """Escape literal braces and turn source names after FROM into DataFrame placeholders."""
    sql = sql.replace("{", "{{").replace("}", "}}")
    for s in sources:
        sql = sql.replace(f"FROM {s}", "FROM {" + s + "}")
    return sql


def envelope(hits: DataFrame) -> DataFrame:
    """Bus envelope of a carrier that has routing key, exchange, content type and body text."""
    return hits.select(
        *hits.columns[: hits.columns.index("routing_key")],
        F.col("body").cast("binary").alias("body"),
        "routing_key",
        "content_type",
        "exchange",
        F.create_map(F.lit("sensorId"), F.col("user_id").cast("string")).alias("headers"),
        F.timestamp_micros("us").alias("ingest_ts"),
    )


def _when_family(fam: int, *fields: Column, also: Column | None = None) -> Column:
    present = F.col("fam") == fam if also is None else (F.col("fam") == fam) & also
    return F.when(present, F.struct(*fields))


def sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_flat`` nested into the message layout of ``sources.sensor_schema``, with bus headers."""
    c = F.col
    flat = view(spark, sf_dir, "sensor_flat")
    text, ok = c("text"), F.lit(True)
    own_md5 = F.when(c("has_own"), F.unhex("own_md5"))
    own_sha = F.when(c("has_own"), F.unhex("own_sha"))
    raw = lambda x: x.cast("binary")
    v4 = lambda x: F.struct(F.lit(False).alias("bIsIpv6"), x.alias("ipv4Address"))
    v6 = lambda: F.struct(
        c("even").alias("bIsIpv6"),
        c("ip_a").alias("ipv4Address"),
        (c("ip_b") * 65536).cast("decimal(20,0)").alias("ipv6Low"),
        F.lit(33022).cast("decimal(20,0)").alias("ipv6High"),
        F.when(c("small") == 4, F.lit("eth0")).alias("ipv6Scope"),
    )
    small = lambda n: (c("small") % n).cast("int")
    parts = {
        "header": F.struct(
            F.lit(4).alias("version"), c("h_ts").alias("timestamp"), c("h_guid").alias("process_guid"),
            c("h_path_guid").alias("filepath_string_guid"), c("h_ct").alias("process_create_time"),
            c("h_pid").cast("int").alias("process_pid"), F.unhex("h_md5").alias("process_md5"),
            c("h_path").alias("process_path"), c("h_fork").cast("int").alias("fork_pid"),
            F.unhex("h_sha").alias("process_sha256"),
        ),
        "strings": F.filter(
            F.array(
                F.struct((c("h_path_guid") + 1).alias("guid"), raw(F.lit("other")).alias("utf8string")),
                F.when(c("path").isNotNull(), F.struct(c("h_path_guid").alias("guid"), raw(c("path")).alias("utf8string"))),
                F.when(c("path").isNotNull(), F.struct(c("h_path_guid").alias("guid"), raw(F.lit("second")).alias("utf8string"))),
            ),
            lambda s: s.isNotNull(),
        ),
        "process": F.when(c("fam").isin(0, 15), F.struct(
            (c("fam") == 0).alias("created"), F.when(c("even"), c("user_id")).cast("int").alias("parent_pid"),
            c("h_ct").alias("parent_create_time"), c("h_guid").alias("parent_guid"), own_md5.alias("md5hash"),
            raw(text).alias("commandline"), own_md5.alias("parent_md5"), c("h_path").alias("parent_path"),
            (c("small") > 9).alias("expect_followon_w_md5"), F.when(c("has_own"), "0").alias("uid"),
            c("h_path").alias("username"), own_sha.alias("sha256hash"), own_sha.alias("parent_sha256"),
        )),
        "modload": _when_family(1, own_md5.alias("md5hash"), own_sha.alias("sha256hash")),
        "filemod": _when_family(
            2, F.when(small(5) > 0, F.get(F.array(*[F.lit(n) for n in (1, 2, 4, 8)]), small(5) - 1)).alias("action"), own_md5.alias("md5hash"),
            small(4).alias("type"), (c("small") > 9).alias("tamper"), own_sha.alias("sha256hash"),
        ),
        "networkv2": _when_family(
            3, F.when(c("small") > 9, 17).alias("protocol"), raw(text).alias("utf8_netpath"),
            F.when(c("small") > 4, c("small") > 9).alias("outbound"), (c("small") > 13).alias("proxyConnection"),
            v4(c("ip_b")).alias("proxyIpAddress"), c("port_b").alias("proxyPort"), text.alias("proxyNetPath"),
            v6().alias("remoteIpAddress"), c("port_a").alias("remotePort"), v4(c("ip_a")).alias("localIpAddress"),
            c("port_b").alias("localPort"), c("h_path").alias("ja3"),
        ),
        "network": _when_family(
            4, c("ip_a").alias("ipv4Address"), c("port_a").alias("port"), F.when(c("small") > 9, 17).alias("protocol"),
            raw(text).alias("utf8_netpath"), (c("small") > 9).alias("outbound"),
            F.when(c("has_own"), c("ip_a")).alias("remoteIpAddress"), c("port_a").alias("remotePort"),
            F.when(~c("has_own"), c("ip_b")).alias("localIpAddress"), c("port_b").alias("localPort"),
        ),
        "regmod": _when_family(
            5, F.when(small(5) > 0, F.get(F.array(*[F.lit(n) for n in (1, 2, 4, 8)]), small(5) - 1)).alias("action"), raw(text).alias("utf8_regpath"),
            (c("small") > 9).alias("tamper"), ok.alias("tamper_sent"),
        ),
        "childproc": _when_family(
            6, (c("small") > 4).alias("created"), c("h_guid").alias("parent_guid"), own_md5.alias("md5hash"),
            (c("h_guid") + 1).alias("child_guid"), c("h_path").alias("path"),
            F.when(c("small") != 6, c("event_id") * 9).alias("pid"), (c("win") - 5).alias("create_time"),
            F.struct((c("small") > 9).alias("bIsSuppressed")).alias("suppressed"), raw(text).alias("commandline"),
            c("h_path").alias("username"), small(4).alias("childProcType"), own_sha.alias("sha256hash"),
        ),
        "crossproc": _when_family(
            7,
            F.when(c("user_id") % 2 == 0, F.struct(
                small(4).alias("type"), c("ip_a").alias("targetPid"),
                c("win").cast("decimal(20,0)").alias("targetProcCreateTime"), (c("small") * 100).cast("bigint").alias("requestedAccess"),
                c("h_path").alias("targetProcPath"), own_md5.alias("targetProcMd5"), own_sha.alias("targetProcSha256"),
            )).alias("open"),
            F.when(c("user_id") % 2 == 1, F.struct(
                c("ip_a").alias("remoteProcPid"), c("win").cast("decimal(20,0)").alias("remoteProcCreateTime"),
                c("h_path").alias("remoteProcPath"), own_md5.alias("remoteProcMd5"), own_sha.alias("remoteProcSha256"),
            )).alias("remotethread"),
            (c("small") > 9).alias("isTarget"),
        ),
        "emet": _when_family(
            8, c("event_id").cast("decimal(20,0)").alias("emetId"), c("win").cast("decimal(20,0)").alias("emetTimstamp"),
            F.struct((c("small") + 1).alias("mitigationType")).alias("action"), text.alias("actionText"),
            (c("small") > 9).alias("blocked"),
        ),
        "scriptexe": _when_family(9, text.alias("script"), c("own_sha").alias("sha256")),
        "tamperAlert": F.when((c("fam") == 10) | (c("fam32") == 13), F.struct(small(7).alias("type"))),
        "blocked": _when_family(
            11, F.when(c("small") > 4, 1).alias("blockedType"), (small(3) + 1).alias("blockedEvent"),
            own_md5.alias("blockedmd5Hash"), c("h_path").alias("blockedPath"), small(8).alias("blockResult"),
            c("user_id").alias("blockError"), F.when(c("has_own"), c("h_pid")).cast("int").alias("blockedPid"),
            c("win").cast("decimal(20,0)").alias("blockedProcCreateTime"), text.alias("blockedCmdline"),
            c("host").alias("blockedUid"), c("h_path").alias("blockedUsername"),
        ),
        "module": _when_family(
            12, raw(c("own_md5")).alias("md5"), c("ip_a").alias("CopiedModuleLength"),
            c("win").cast("decimal(20,0)").alias("OriginalModuleLength"), text.alias("utf8_FileDescription"),
            c("host").alias("utf8_CompanyName"), c("h_path").alias("utf8_ProductName"),
            c("host").alias("utf8_DigSig_Publisher"), text.alias("utf8_DigSig_Result"),
            F.when(c("has_own"), raw(text)).alias("Icon"), raw(c("own_sha")).alias("sha256"),
        ),
        "netconnBlocked": _when_family(
            13, c("ip_a").alias("ipv4Address"), c("port_a").alias("port"), raw(text).alias("utf8_netpath"),
            c("ip_b").alias("remoteIpAddress"), c("port_b").alias("remotePort"),
        ),
        "netconnBlockedv2": F.when(c("fam") == 14, F.struct(
            raw(text).alias("utf8_netpath"), (c("small") > 9).alias("outbound"), c("even").alias("proxyConnection"),
            v4(c("ip_b")).alias("proxyIpAddress"), c("port_b").alias("proxyPort"), text.alias("proxyNetPath"),
            v6().alias("remoteIpAddress"), c("port_a").alias("remotePort"), v4(c("ip_a")).alias("localIpAddress"),
            c("port_b").alias("localPort"),
        )),
        "env": F.when(~c("env_from_headers"), F.struct(
            F.struct(c("sensor").cast("int").alias("SensorId"), c("host").alias("SensorHostName"), c("user_id").alias("HostId")).alias("endpoint"),
        )),
    }
    headers = F.map_filter(
        F.create_map(
            F.lit("sensorId"), F.when(c("env_from_headers"), c("sensor").cast("string")),
            F.lit("sensorHostName"), c("host"), F.lit("hostId"), c("user_id").cast("string"),
        ),
        lambda _, v: v.isNotNull(),
    )
    made = flat.select(*[p.alias(name) for name, p in parts.items()]).schema
    message = [
        (fit(parts[f.name], made[f.name].dataType, f.dataType) if f.name in parts else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in spark_type()
    ]
    return flat.select(*flat.columns, headers.alias("headers"), *message)
