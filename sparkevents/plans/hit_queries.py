"""Queries over JSON hits: filters, normalization rules, encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import variants as V
from ..operators import encode, filters, hits
from ..sources.audit import audit_events
from . import carriers
from .carriers import RAW_EXCHANGE
from .registry import Tables, query, text, texts

URL = "https://console.example.org/"
SERVER = "server-1"
CONF = {
    "events_watchlist": "ALL",
    "events_feed": "feed.*.storage.hit.process,feed.1.#",
    "events_alert": "0",
    "events_binary_observed": "all",
    "task_errors": "task.error.*",
}
PATTERN_SQL = (
    "(routing_key LIKE 'watchlist.%' OR regexp_full_match(routing_key, 'feed\\.[^.]+\\.storage\\.hit\\.process')"
    " OR routing_key = 'feed.1' OR routing_key LIKE 'feed.1.%' OR routing_key LIKE 'binaryinfo.%'"
    " OR regexp_full_match(routing_key, 'task\\.error\\.[^.]+'))"
)
J = "json_extract_string"


# ---- subscriptions and filters ---------------------------------------------------------------------------------------


@query(
    "parse_subscriptions",
    """SELECT pattern, count(*) AS n FROM bus_hits, LATERAL (
         SELECT 'watchlist.#' AS pattern WHERE routing_key LIKE 'watchlist.%'
         UNION ALL SELECT 'feed.*.storage.hit.process' WHERE regexp_full_match(routing_key, 'feed\\.[^.]+\\.storage\\.hit\\.process')
         UNION ALL SELECT 'feed.1.#' WHERE routing_key LIKE 'feed.1.%'
         UNION ALL SELECT 'binaryinfo.#' WHERE routing_key LIKE 'binaryinfo.%'
         UNION ALL SELECT 'task.error.*' WHERE regexp_full_match(routing_key, 'task\\.error\\.[^.]+')) AS p
       GROUP BY pattern""",
    ("bus_hits",),
)
def parse_subscriptions(t: Tables):
    """How many messages each subscribed pattern admits."""
    rk = F.col("routing_key")
    hit = F.array(*[F.when(filters.matches_any(rk, [p]), p) for p in filters.parse_subscriptions(CONF)])
    matched = t.view("bus_hits").select(F.explode(F.filter(hit, lambda p: p.isNotNull())).alias("pattern"))
    return matched.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


@query("subscribe_filter", f"SELECT event_id, routing_key FROM bus_hits WHERE {PATTERN_SQL}", ("bus_hits",))
def subscribe_filter(t: Tables):
    rows = filters.subscribe_filter(t.view("bus_hits"), filters.parse_subscriptions(CONF))
    return rows.select("event_id", "routing_key")


@query("subscribe_join", f"SELECT event_id, routing_key FROM bus_hits WHERE {PATTERN_SQL}", ("bus_hits",))
def subscribe_join(t: Tables):
    patterns = filters.pattern_table(t.spark, filters.parse_subscriptions(CONF))
    return filters.subscribe_join(t.view("bus_hits"), patterns).select("event_id", "routing_key")


ROUTE_SQL = f"""CASE WHEN content_type = 'application/zip' THEN 'bundle'
    WHEN content_type = 'application/protobuf' AND exchange = '{RAW_EXCHANGE}' THEN 'bundle'
    WHEN content_type = 'application/protobuf' THEN 'single' WHEN content_type = 'application/json' THEN 'json' END"""


@query(
    "dispatch_content_type",
    f"""SELECT event_id, {ROUTE_SQL} AS route, CASE WHEN {ROUTE_SQL} IS NULL THEN 'unknown content type' END AS error
        FROM bus_bad""",
    ("bus_bad",),
)
def dispatch_content_type(t: Tables):
    return filters.dispatch_content_type(t.view("bus_bad"), RAW_EXCHANGE).select("event_id", "route", "error")


IS_OBJECT = "(json_valid(body) AND json_type(CASE WHEN json_valid(body) THEN body ELSE 'null' END) = 'OBJECT')"


@query(
    "parse_json_body",
    f"""SELECT event_id, CASE WHEN {IS_OBJECT} THEN {J}(body, '$.hostname') END AS hostname,
               CASE WHEN {IS_OBJECT} THEN {J}(body, '$.event_timestamp') END AS event_timestamp,
               CASE WHEN {IS_OBJECT} THEN len(json_keys(body)) END AS n_keys,
               CASE WHEN {IS_OBJECT} THEN NULL ELSE 'body is not a JSON object' END AS error
        FROM bus_bad""",
    ("bus_bad",),
)
def parse_json_body(t: Tables):
    rows = filters.parse_json_body(t.view("bus_bad"))
    return rows.select(
        "event_id", *texts("hostname", "event_timestamp"), F.size(F.map_keys("msg")).cast("bigint").alias("n_keys"), "error"
    )


@query(
    "reject_errors",
    f"""SELECT error, count(*) AS n FROM (
          SELECT CASE WHEN {ROUTE_SQL} IS NULL THEN 'unknown content type'
                      WHEN {ROUTE_SQL} = 'json' AND NOT {IS_OBJECT} THEN 'body is not a JSON object' END AS error FROM bus_bad)
        WHERE error IS NOT NULL GROUP BY error""",
    ("bus_bad",),
)
def reject_errors(t: Tables):
    routed = filters.dispatch_content_type(t.view("bus_bad"), RAW_EXCHANGE)
    parsed = filters.parse_json_body(routed.filter("route = 'json' or error is not null"))
    return filters.error_counts(parsed)


@query("nonempty_filter", "SELECT doc_id, md5(value) AS digest FROM messages WHERE strlen(value) > 0 AND doc_id % 41 <> 0", ("messages",))
def nonempty_filter(t: Tables):
    """Some of the records are made empty here."""
    some = t.view("messages").withColumn("value", F.when(F.col("doc_id") % 41 == 0, "").otherwise(F.col("value")))
    return filters.nonempty_filter(some).select("doc_id", F.md5("value").alias("digest"))


@query(
    "drop_keys",
    """SELECT event_id, (SELECT string_agg(k, ',' ORDER BY k) FROM unnest(json_keys(body)) AS u(k)
         WHERE k NOT IN ('highlights', 'md5', 'comms_ip')) AS keys FROM bus_hits""",
    ("bus_hits",),
)
def drop_keys(t: Tables):
    rows = hits.drop_keys(t.messages_of(), ["md5", " comms_ip "])
    return rows.select("event_id", F.array_join(encode.key_sort(F.col("msg")), ",").alias("keys"))


# ---- normalization rules ---------------------------------------------------------------------------------------------


@query(
    "fix_type",
    r"SELECT event_id, regexp_replace(routing_key, '^feed\.(\d+)\.(.*)$', 'feed.\2') AS type FROM bus_hits",
    ("bus_hits",),
)
def fix_type(t: Tables):
    return hits.fix_type(t.messages_of()).select("event_id", text("type"))


@query(
    "rename_timestamp",
    f"SELECT event_id, {J}(body, '$.event_timestamp') AS timestamp, false AS old_key FROM bus_hits",
    ("bus_hits",),
)
def rename_timestamp(t: Tables):
    rows = hits.rename_timestamp(t.messages_of())
    return rows.select("event_id", text("timestamp"), F.map_contains_key("msg", "event_timestamp").alias("old_key"))


@query(
    "copy_hostname",
    f"SELECT event_id, {J}(body, '$.hostname') AS computer_name, {J}(body, '$.hostname') AS hostname FROM bus_hits",
    ("bus_hits",),
)
def copy_hostname(t: Tables):
    return hits.copy_hostname(t.messages_of()).select("event_id", *texts("computer_name", "hostname"))


def _upper_sql(key: str) -> str:
    v = f"{J}(body, '$.{key}')"
    return f"CASE WHEN strlen({v}) = 32 THEN upper({v}) ELSE {v} END"


@query(
    "upper_md5",
    "SELECT event_id, " + ", ".join(f"{_upper_sql(k)} AS {k}" for k in hits.MD5_KEYS) + " FROM bus_hits",
    ("bus_hits",),
)
def upper_md5(t: Tables):
    return hits.upper_md5(t.messages_of()).select("event_id", *texts(*hits.MD5_KEYS))


@query(
    "fix_ioc_type_map",
    f"""SELECT event_id, json_type(body, '$.ioc_type') AS kind, upper({J}(body, '$.ioc_type.md5')) AS ioc_md5,
               {J}(body, '$.ioc_type.n') AS n FROM bus_hits""",
    ("bus_hits",),
)
def fix_ioc_type_map(t: Tables):
    ioc = F.col("msg")["ioc_type"]
    kind = F.when(V.is_object(ioc), "OBJECT").when(V.is_string(ioc), "VARCHAR")
    inner = V.as_message(F.when(V.is_object(ioc), ioc))
    return hits.fix_ioc_type_map(t.messages_of()).select(
        "event_id", kind.alias("kind"), inner["md5"].cast("string").alias("ioc_md5"), inner["n"].cast("string").alias("n")
    )


BAD_ESCAPE = "regexp_matches(search_query, '%([^0-9a-fA-F]|[0-9a-fA-F]([^0-9a-fA-F]|$)|$)')"


@query(
    "parse_ioc_query",
    f"""SELECT page_id, CASE WHEN good THEN idx END AS ioc_query_index,
               CASE WHEN good THEN url_decode(replace(CASE WHEN piece = 'q' THEN '' ELSE substr(piece, 3) END, '+', ' ')) END AS ioc_query_string
        FROM (SELECT *, kind = 'query' AND idx IS NOT NULL AND piece IS NOT NULL AND n IS NULL AND NOT {BAD_ESCAPE} AS good
              FROM (SELECT *, {J}(body, '$.ioc_type') AS kind, {J}({J}(body, '$.ioc_value'), '$.index_type') AS idx,
                           {J}({J}(body, '$.ioc_value'), '$.n') AS n,
                           list_filter(string_split(search_query, '&'), lambda p: p = 'q' OR starts_with(p, 'q='))[1] AS piece
                    FROM ioc_urls))""",
    ("ioc_urls",),
)
def parse_ioc_query(t: Tables):
    rows = hits.parse_ioc_query(t.messages_of("ioc_urls"))
    return rows.select("page_id", *texts("ioc_query_index", "ioc_query_string"))


def _ip_sql(key: str) -> str:
    n = f"try_cast({J}(body, '$.{key}') AS BIGINT)"
    u = f"(({n}) & 4294967295)"
    dotted = " || '.' || ".join(f"cast(({u} >> {s}) & 255 AS VARCHAR)" for s in (24, 16, 8, 0))
    return f"CASE WHEN {n} BETWEEN -2147483648 AND 2147483647 THEN {dotted} ELSE {J}(body, '$.{key}') END"


@query(
    "fix_ip",
    "SELECT event_id, " + ", ".join(f"{_ip_sql(k)} AS {k}" for k in hits.IP_KEYS) + " FROM bus_hits",
    ("bus_hits",),
)
def fix_ip(t: Tables):
    return hits.fix_ip(t.messages_of()).select("event_id", *texts(*hits.IP_KEYS))


def _guid_parts(v: str) -> tuple[str, str, str]:
    """SQL of guid, segment and whether the text is well-formed."""
    tail = f"substr({v}, 38)"
    is_hex = f"regexp_full_match({tail}, '[0-9A-Fa-f]+')"
    number = f"cast(cast('0x' || CASE WHEN {is_hex} THEN {tail} ELSE '0' END AS BIGINT) AS VARCHAR)"
    guid = f"substr({v}, 1, 36)"
    segment = (
        f"CASE WHEN strlen({v}) IN (45, 49) AND {is_hex} THEN {number} WHEN strlen({v}) = 49 THEN '0'"
        f" WHEN {v} IS NOT NULL THEN '1' END"
    )
    return guid, segment, f"(strlen({v}) = 36 OR (strlen({v}) IN (45, 49) AND {is_hex}))"


_UNIQUE = f"CASE WHEN routing_key NOT LIKE 'alert.%' THEN {J}(body, '$.unique_id') END"
_PROCESS = f"CASE WHEN {_guid_parts('uid')[2]} THEN uid ELSE pid END"
GUID_ROWS = f"""SELECT *, {_PROCESS} AS src FROM (
    SELECT *, {_UNIQUE} AS uid, {J}(body, '$.process_id') AS pid, {J}(body, '$.parent_unique_id') AS parent_id FROM bus_hits)"""


@query(
    "process_guid_segment",
    f"SELECT event_id, {_guid_parts('src')[0]} AS process_guid, {_guid_parts('src')[1]} AS segment_id FROM ({GUID_ROWS})",
    ("bus_hits",),
)
def process_guid_segment(t: Tables):
    return hits.process_guid_segment(t.messages_of()).select("event_id", *texts("process_guid", "segment_id"))


@query(
    "parent_guid_segment",
    f"""SELECT event_id, {_guid_parts('parent_id')[0]} AS parent_guid, {_guid_parts('parent_id')[1]} AS parent_segment_id
        FROM ({GUID_ROWS})""",
    ("bus_hits",),
)
def parent_guid_segment(t: Tables):
    return hits.parent_guid_segment(t.messages_of()).select("event_id", *texts("parent_guid", "parent_segment_id"))


LINKS = ("link_sensor", "link_md5", "link_parent_md5", "link_process_md5", "link_process", "link_parent")


def _md5_link_sql(key: str, value: str) -> str:
    return f"CASE WHEN strlen({value}) = 32 THEN '{URL}#/binary/' || {value} END AS link_{key}"


def _links_sql(source: str, md5_of) -> str:
    src, seg, _ = _guid_parts("src")
    parent, pseg, _ = _guid_parts("parent_id")
    return f"""SELECT event_id, '{URL}#/host/' || {J}(body, '$.sensor_id') AS link_sensor,
        {", ".join(_md5_link_sql(k, md5_of(k)) for k in hits.MD5_KEYS)},
        '{URL}#analyze/' || {src} || '/' || {seg} AS link_process,
        '{URL}#analyze/' || {parent} || '/' || {pseg} AS link_parent FROM ({source})"""


@query("add_links", _links_sql(GUID_ROWS, lambda k: f"{J}(body, '$.{k}')"), ("bus_hits",))
def add_links(t: Tables):
    rows = hits.parent_guid_segment(hits.process_guid_segment(t.messages_of()))
    return hits.add_links(rows, URL[:-1]).select("event_id", *texts(*LINKS))


@query("add_server", f"SELECT event_id, '{SERVER}' AS cb_server FROM bus_hits", ("bus_hits",))
def add_server(t: Tables):
    return hits.add_server(t.messages_of(), SERVER).select("event_id", text("cb_server"))


DOC_ROWS = """SELECT h.o_orderkey, h.o_custkey, h.body, h.routing_key, h.n_docs, d.pos
    FROM hit_docs AS h, LATERAL (SELECT unnest(range(0, greatest(h.n_docs, 0))) AS pos) AS d
    UNION ALL SELECT o_orderkey, o_custkey, body, routing_key, n_docs, NULL AS pos FROM hit_docs WHERE n_docs = -1"""


@query(
    "explode_docs",
    f"""SELECT o_orderkey, pos AS doc_pos, {J}(body, '$.server_name') AS server_name,
               {J}(body, '$.docs[' || cast(pos AS VARCHAR) || '].n') AS n,
               CASE WHEN pos IS NOT NULL THEN 1 END AS n_docs FROM ({DOC_ROWS})""",
    ("hit_docs",),
)
def explode_docs(t: Tables):
    rows = hits.explode_docs(t.messages_of("hit_docs"))
    docs = F.col("msg")["docs"].try_cast("array<variant>")
    doc = V.as_message(F.get(docs, F.lit(0)))
    return rows.select(
        "o_orderkey",
        F.col("doc_pos").cast("bigint").alias("doc_pos"),
        text("server_name"),
        doc["n"].cast("string").alias("n"),
        F.when(docs.isNotNull(), F.size(docs)).cast("int").alias("n_docs"),
    )


@query(
    "explode_docs_errors",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 OR o_orderkey % 5 = 3 THEN NULL ELSE pos END AS doc_pos,
              CASE WHEN o_orderkey % 5 IN (0, 1, 3) THEN 'docs is not an array'
                   WHEN o_orderkey % 5 = 2 AND pos = 0 OR o_orderkey % 5 = 4 AND pos = 1 THEN 'element of docs is not an object'
              END AS error,
              CASE WHEN o_orderkey % 5 = 2 AND pos = 1 OR o_orderkey % 5 = 4 AND pos = 0 THEN cast(o_custkey AS VARCHAR) END AS y
       FROM orders, (SELECT unnest([0, 1])::BIGINT AS pos) WHERE o_orderkey % 5 IN (2, 4) OR pos = 0""",
)
def explode_docs_errors(t: Tables):
    """Messages whose ``docs`` is an object, null, text, or an array with elements that are no objects."""
    docs = F.expr(
        """CASE o_orderkey % 5 WHEN 0 THEN '{"x":1}' WHEN 1 THEN 'null' WHEN 3 THEN '"t"'
           WHEN 2 THEN '[1,{"y":' || o_custkey || '}]' ELSE '[{"y":' || o_custkey || '},null]' END"""
    )
    body = F.concat(F.lit('{"a":1,"docs":'), docs, F.lit("}"))
    parsed = filters.parse_json_body(t.view("orders").select("o_orderkey", body.alias("body")))
    rows = hits.explode_docs(parsed)
    doc = V.as_message(F.get(F.col("msg")["docs"].try_cast("array<variant>"), F.lit(0)))
    return rows.select("o_orderkey", F.col("doc_pos").cast("bigint").alias("doc_pos"), "error", doc["y"].cast("string").alias("y"))


def _doc(key: str) -> str:
    return f"{J}(body, '$.docs[' || cast(pos AS VARCHAR) || '].{key}')"


def _big_endian(v: str) -> str:
    parts = " || '.' || ".join(f"cast((cast({v} AS BIGINT) >> {s}) & 255 AS VARCHAR)" for s in (24, 16, 8, 0))
    return f"CASE WHEN cast({v} AS BIGINT) <= 2147483647 THEN {parts} ELSE {v} END"


@query(
    "normalize_hits",
    f"""SELECT o_orderkey, pos AS doc_pos, {J}(body, '$.event_timestamp') AS timestamp, '{SERVER}' AS cb_server,
               regexp_replace(routing_key, '^feed\\.(\\d+)\\.(.*)$', 'feed.\\2') AS type, '5.1' AS cb_version,
               {_doc("hostname")} AS computer_name, upper({_doc("md5")}) AS md5, {_big_endian(_doc("comms_ip"))} AS comms_ip,
               {_doc("unique_id")} AS process_guid, CASE WHEN pos IS NOT NULL THEN '1' END AS segment_id,
               '{URL}#/binary/' || upper({_doc("md5")}) AS link_md5,
               '{URL}#analyze/' || {_doc("unique_id")} || '/1' AS link_process
        FROM ({DOC_ROWS})""",
    ("hit_docs",),
)
def normalize_hits(t: Tables):
    """The whole hit path on messages with sub-documents; document fields beside the root's."""
    rows = hits.normalize_hits(t.messages_of("hit_docs"), SERVER, URL)
    docs = F.col("msg")["docs"].try_cast("array<variant>")
    rows = rows.withColumn("doc", V.as_message(F.get(docs, F.lit(0))))
    return rows.select(
        "o_orderkey",
        F.col("doc_pos").cast("bigint").alias("doc_pos"),
        *texts("timestamp", "cb_server", "type", "cb_version"),
        *texts("computer_name", "md5", "comms_ip", "process_guid", "segment_id", "link_md5", "link_process", m="doc"),
    )


NORMALIZED = (
    "timestamp", "type", "cb_server", "computer_name", *hits.MD5_KEYS, *hits.IP_KEYS, "process_guid", "segment_id",
    "parent_guid", "parent_segment_id", *LINKS,
)


def _normalized_sql(where: str = "") -> str:
    src, seg, _ = _guid_parts("src")
    parent, pseg, _ = _guid_parts("parent_id")
    return f"""SELECT n.event_id, {J}(body, '$.event_timestamp') AS timestamp,
        regexp_replace(routing_key, '^feed\\.(\\d+)\\.(.*)$', 'feed.\\2') AS type, '{SERVER}' AS cb_server,
        {J}(body, '$.hostname') AS computer_name, {", ".join(f"{_upper_sql(k)} AS {k}" for k in hits.MD5_KEYS)},
        {", ".join(f"{_ip_sql(k)} AS {k}" for k in hits.IP_KEYS)}, {src} AS process_guid,
        {seg} AS segment_id, {parent} AS parent_guid, {pseg} AS parent_segment_id,
        {", ".join("l." + k for k in LINKS)}
        FROM ({GUID_ROWS}) AS n JOIN ({_links_sql(GUID_ROWS, _upper_sql)}) AS l ON l.event_id = n.event_id {where}"""


@query("flagship", _normalized_sql(f"WHERE {PATTERN_SQL}"), ("bus_hits",))
def flagship(t: Tables):
    """Subscribe, parse, normalize and encode; then read the wanted keys back out of the encoded text."""
    wanted = filters.subscribe_filter(t.view("bus_hits"), filters.parse_subscriptions(CONF))
    good, _ = filters.reject_errors(filters.parse_json_body(wanted))
    events = encode.encode_json(filters.reject_errors(hits.normalize_hits(good, SERVER, URL))[0])
    parsed = F.from_json("value", "map<string,string>")
    return events.select("event_id", parsed.alias("e")).select("event_id", *[F.col("e")[k].alias(k) for k in NORMALIZED])


# ---- encoders --------------------------------------------------------------------------------------------------------


@query(
    "encode_json",
    "SELECT event_id, key, cast(value AS VARCHAR) AS value_text FROM bus_hits, LATERAL json_each(body) AS e",
    ("bus_hits",),
)
def encode_json(t: Tables):
    """Leaves of the encoded text, key by key."""
    rows = encode.encode_json(t.messages_of())
    return rows.select("event_id", F.explode(F.from_json("value", V.MESSAGE)).alias("key", "v")).select(
        "event_id", "key", F.to_json("v").alias("value_text")
    )


def exact_events(t: Tables):
    hit = t.view("exact_hits").select("o_orderkey", F.expr(carriers.EXACT_BODY).alias("body"))
    return filters.reject_errors(filters.parse_json_body(hit))[0]


@query("number_text_json", f"SELECT o_orderkey, {carriers.EXACT_BODY} AS value FROM exact_hits", ("exact_hits",))
def number_text_json(t: Tables):
    """Numbers of any text come out as they came in."""
    return encode.encode_json(exact_events(t)).select("o_orderkey", "value")


@query(
    "leef_any_depth",
    """SELECT o_orderkey, concat_ws(chr(9), 'LEEF:1.0|CB|CB|5.1|unknown.event.type|big=' || digits,
              'deep=[' || inner_leef || ' ' || pairs_leef || ']', 'ends=' || ends, 'like=1.10,"2.50"',
              'o={"p":' || point || '}', 'power=' || power, 'who=' || o_orderpriority) AS value FROM exact_hits""",
    ("exact_hits",),
)
def leef_any_depth(t: Tables):
    """Numbers as they came in and nested values at any depth."""
    return encode.encode_leef(exact_events(t)).select("o_orderkey", "value")


@query(
    "key_sort",
    "SELECT event_id, (SELECT string_agg(k, ',' ORDER BY k) FROM unnest(json_keys(body)) AS u(k)) AS keys FROM bus_hits",
    ("bus_hits",),
)
def key_sort(t: Tables):
    rows = encode.encode_json(t.messages_of())
    return rows.select("event_id", F.array_join(F.json_object_keys("value"), ",").alias("keys"))


def _escaped(v: str) -> str:
    for raw, out in (("chr(92)", "chr(92) || chr(92)"), ("chr(10)", "chr(92) || 'n'"), ("chr(13)", "chr(92) || 'r'"),
                     ("chr(9)", "chr(92) || 't'"), ("'='", "chr(92) || '='")):
        v = f"replace({v}, {raw}, {out})"
    return v


def _rendered(v: str) -> str:
    element = "CASE WHEN json_type(x) = 'NULL' THEN '<nil>' ELSE x ->> '$' END"
    return f"""CASE json_type({v}) WHEN 'OBJECT' THEN CASE WHEN cast({v} AS VARCHAR) = '{{}}' THEN '' ELSE cast({v} AS VARCHAR) END
        WHEN 'ARRAY' THEN '[' || array_to_string(list_transform(json_extract({v}, '$[*]'), lambda x: {element}), ' ') || ']'
        ELSE {_escaped(f"({v} ->> '$')")} END"""


@query("leef_escape", f"SELECT doc_id, md5({_escaped('text')}) AS digest FROM documents")
def leef_escape(t: Tables):
    return t.view("documents").select("doc_id", F.md5(encode.leef_escape(F.col("text"))).alias("digest"))


@query(
    "leef_render",
    f"""SELECT event_id, key, {_rendered("value")} AS rendered FROM bus_hits, LATERAL json_each(body) AS e
        WHERE json_type(value) <> 'NULL'""",
    ("bus_hits",),
)
def leef_render(t: Tables):
    rows = t.messages_of().select("event_id", F.explode("msg").alias("key", "v")).filter(~F.is_variant_null("v"))
    return rows.select("event_id", "key", encode.leef_render(F.col("v")).alias("rendered"))


NET_SQL = ", ".join(
    f"CASE WHEN {J}(body, '$.ioc_attr.direction') = 'inbound' THEN {J}(body, '$.ioc_attr.{when_in}')"
    f" ELSE {J}(body, '$.ioc_attr.{when_out}') END AS \"{field}\""
    for field, (when_out, when_in) in encode.NET_FIELDS.items()
)


@query("leef_net_fields", f"SELECT event_id, {NET_SQL}, NULL::VARCHAR AS error FROM bus_hits", ("bus_hits",))
def leef_net_fields(t: Tables):
    return encode.leef_net_fields(t.messages_of()).select("event_id", *texts(*encode.NET_FIELDS), "error")


@query(
    "leef_promote_docs",
    f"""SELECT o_orderkey, pos AS doc_pos, coalesce({_doc("cb_version")}, '5.1') AS cb_version, {_doc("n")} AS n,
               {_doc("hostname")} AS hostname, {J}(body, '$.server_name') AS server_name, false AS has_docs,
               NULL::VARCHAR AS error FROM ({DOC_ROWS})""",
    ("hit_docs",),
)
def leef_promote_docs(t: Tables):
    rows = encode.leef_promote_docs(hits.explode_docs(t.messages_of("hit_docs")))
    return rows.select(
        "o_orderkey",
        F.col("doc_pos").cast("bigint").alias("doc_pos"),
        *texts("cb_version", "n", "hostname", "server_name"),
        F.map_contains_key("msg", "docs").alias("has_docs"),
        "error",
    )


@query(
    "encode_leef",
    f"""SELECT event_id, 'LEEF:1.0|CB|CB|' || coalesce({J}(body, '$.cb_version'), '5.1') || '|' || type || '|' || pairs AS value
        FROM (SELECT h.event_id, any_value(h.body) AS body, any_value(h.type) AS type,
                     string_agg(h.key || '=' || h.rendered, chr(9) ORDER BY h.key) AS pairs
              FROM (
                SELECT event_id, body, {_rendered("e.value")} AS rendered, e.key AS key, r.type AS type
                FROM (SELECT *, regexp_replace(routing_key, '^feed\\.(\\d+)\\.(.*)$', 'feed.\\2') AS type FROM bus_hits) AS r,
                     LATERAL json_each(body) AS e WHERE json_type(e.value) <> 'NULL'
                UNION ALL SELECT event_id, body, type, 'type', type
                FROM (SELECT *, regexp_replace(routing_key, '^feed\\.(\\d+)\\.(.*)$', 'feed.\\2') AS type FROM bus_hits)
                UNION ALL SELECT event_id, body, value, field, type FROM (
                  UNPIVOT (SELECT event_id, body, regexp_replace(routing_key, '^feed\\.(\\d+)\\.(.*)$', 'feed.\\2') AS type,
                                  {NET_SQL} FROM bus_hits) ON src, dst, proto, "srcPort", "dstPort"
                  INTO NAME field VALUE value)) AS h
              GROUP BY h.event_id)""",
    ("bus_hits",),
)
def encode_leef(t: Tables):
    return encode.encode_leef(hits.fix_type(t.messages_of())).select("event_id", "value")


AUDIT_TYPE_SQL = "'audit.log.' || replace(log, '-', '')"


@query(
    "audit_json",
    f"""SELECT conv_id, turn, message, {AUDIT_TYPE_SQL} AS type, '{SERVER}' AS cb_server FROM audit_lines""",
    ("audit_lines",),
)
def audit_json(t: Tables):
    rows = encode.audit_json(audit_events(t.view("audit_lines")), SERVER)
    e = F.from_json("value", "message string, type string, cb_server string")
    return rows.select("conv_id", "turn", e.alias("e")).select("conv_id", "turn", "e.message", "e.type", "e.cb_server")


@query(
    "union_sources",
    f"""SELECT type, count(*) AS n, count(*) FILTER (event_id IS NULL) AS audit_lines FROM (
          SELECT event_id, routing_key AS type FROM bus_hits
          UNION ALL SELECT NULL, {AUDIT_TYPE_SQL} FROM audit_lines) GROUP BY type""",
    ("bus_hits", "audit_lines"),
)
def union_sources(t: Tables):
    """Bus events and audit lines in one output channel."""
    events = t.view("bus_hits").select("event_id", F.col("routing_key").alias("type"))
    lines = audit_events(t.view("audit_lines")).select("type")
    return filters.union_sources(events, lines).groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_id").isNull()).alias("audit_lines")
    )
