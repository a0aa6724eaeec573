"""Queries over routing, bundles, sinks, counters, comparison and delivery."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators import bundles, delivery, diff, encode, filters, meters, sinks, stats
from ..sources.envelope import read_envelope, read_json_lines_export, read_routing_dirs, replay
from .carriers import RAW_EXCHANGE
from .hit_queries import IS_OBJECT, J
from .registry import Tables, query, texts

MAX_BYTES = 20_000
CHUNK_BYTES = 30_000


# ---- sources ---------------------------------------------------------------------------------------------------------


@query(
    "read_envelope",
    """SELECT event_id, event_type AS routing_key, 'application/json' AS content_type, 'api.events' AS exchange, props AS body,
              cast(user_id AS VARCHAR) AS sensor_id, epoch_us(ts) AS us FROM events""",
)
def read_envelope_query(t: Tables):
    columns = {
        "event_id": "event_id",
        "body": "props",
        "routing_key": "event_type",
        "content_type": "'application/json'",
        "exchange": "'api.events'",
        "headers": "map('sensorId', cast(user_id as string))",
        "ingest_ts": "ts",
    }
    rows = read_envelope(t.spark, f"{t.sf_dir}/events.parquet", "parquet", columns)
    return rows.select(
        "event_id", "routing_key", "content_type", "exchange", F.col("body").cast("string").alias("body"),
        F.col("headers")["sensorId"].alias("sensor_id"), F.unix_micros("ingest_ts").alias("us"),
    )


@query("replay", "SELECT event_id, r AS replay_no, md5(body) AS digest FROM bus_hits, range(3) AS x(r)", ("bus_hits",))
def replay_query(t: Tables):
    return replay(t.view("bus_hits"), 3).select("event_id", "replay_no", F.md5("body").alias("digest"))


@query(
    "read_json_lines_export",
    f"""SELECT CASE WHEN {IS_OBJECT} THEN {J}(body, '$.hostname') END AS hostname,
               CASE WHEN {IS_OBJECT} THEN {J}(body, '$.comms_ip') END AS comms_ip, count(*) AS n,
               count(*) FILTER (NOT {IS_OBJECT}) AS bad FROM bus_bad WHERE body <> '' GROUP BY ALL""",
    ("bus_bad",),
)
def read_json_lines_export_query(t: Tables):
    """Bodies written as newline JSON and read back."""
    path = t.scratch("export")
    sinks.write_text(t.view("bus_bad").select(F.col("body").alias("value")).filter("value <> ''"), path)
    rows = read_json_lines_export(t.spark, path).select(*texts("hostname", "comms_ip"), "error")
    return rows.groupBy("hostname", "comms_ip").agg(
        F.count(F.lit(1)).alias("n"), F.count("error").alias("bad")
    )


@query(
    "read_routing_dirs",
    "SELECT routing_key, count(*) AS messages, cast(sum(strlen(body) + 1) AS BIGINT) AS n_bytes FROM bus_hits GROUP BY routing_key",
    ("bus_hits",),
)
def read_routing_dirs_query(t: Tables):
    """Bodies written below one directory per routing key, then read back file by file."""
    path = t.scratch("corpus")
    rows = t.view("bus_hits").select("routing_key", F.col("body").alias("value"))
    rows.write.partitionBy("routing_key").option("maxRecordsPerFile", 10_000).text(path)
    found = read_routing_dirs(t.spark, path, "txt")
    lines = F.size(F.split(F.col("body").cast("string"), "\n")) - 1
    return found.groupBy("routing_key").agg(
        F.sum(lines).alias("messages"), F.sum(F.octet_length("body").cast("bigint")).alias("n_bytes")
    )


# ---- routing and sinks -----------------------------------------------------------------------------------------------


@query(
    "topic_records",
    """SELECT event_id, replace('ingress.event.' || event_type, 'ingress.event.', '') || '-x' AS topic, NULL::VARCHAR AS key,
              md5('{"id":' || cast(event_id AS VARCHAR) || ',"type":"ingress.event.' || event_type || '"}') AS digest
       FROM events WHERE event_id % 13 <> 0""",
)
def topic_records(t: Tables):
    """Topic from each event's own type; records whose type is a number are dropped."""
    kind = F.when(F.col("event_id") % 13 == 0, F.lit("7")).otherwise(
        F.concat(F.lit('"ingress.event.'), "event_type", F.lit('"'))
    )
    value = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"type":'), kind, F.lit("}"))
    rows = t.view("events").select("event_id", value.alias("value"))
    return sinks.topic_records(rows, suffix="-x").select("event_id", "topic", "key", F.md5("value").alias("digest"))


@query(
    "line_frames",
    "SELECT doc_id, md5(value || chr(13) || chr(10)) AS tcp, md5(value) AS udp FROM messages WHERE value <> ''",
    ("messages",),
)
def line_frames(t: Tables):
    rows = filters.nonempty_filter(t.view("messages"))
    framed = sinks.line_frames(sinks.line_frames(rows, "tcp", out="tcp"), "udp", out="udp")
    return framed.select("doc_id", F.md5("tcp").alias("tcp"), F.md5("udp").alias("udp"))


@query(
    "capture_raw",
    """SELECT event_id, 'json/' || routing_key || '/' || cast(row_number() OVER (PARTITION BY routing_key ORDER BY event_id) - 1
              AS VARCHAR) || '.json' AS file FROM bus_hits""",
    ("bus_hits",),
)
def capture_raw(t: Tables):
    return sinks.capture_raw(t.view("bus_hits"), None, "event_id", rows_per_segment=50_000).select("event_id", "file")


@query(
    "capture_raw_files",
    """SELECT 'json/' || routing_key || '/' || cast(row_number() OVER (PARTITION BY routing_key ORDER BY event_id) - 1 AS VARCHAR)
              || '.json' AS file, md5(body) AS digest FROM bus_hits""",
    ("bus_hits",),
)
def capture_raw_files(t: Tables):
    """Captured bodies as they lie in the folder."""
    path = t.scratch("captured")
    sinks.capture_raw(t.view("bus_hits"), path, "event_id", rows_per_segment=50_000)
    found = t.spark.read.schema("n bigint, body string, mime string, routing_key string").parquet(path)
    name = F.concat_ws("/", "mime", "routing_key", F.concat_ws(".", "n", "mime"))
    return found.select(name.alias("file"), F.md5("body").alias("digest"))


@query(
    "quarantine",
    f"""SELECT event_id, 'bundle-' || upper(md5(body)) AS file, 'body is not a JSON object' AS error FROM bus_bad
        WHERE NOT {IS_OBJECT}""",
    ("bus_bad",),
)
def quarantine(t: Tables):
    return sinks.quarantine(filters.parse_json_body(t.view("bus_bad"))).select("event_id", "file", "error")


@query(
    "day_partition",
    "SELECT event_id, strftime(make_timestamp(us), '%Y-%m-%d') AS day FROM bus_hits",
    ("bus_hits",),
)
def day_partition(t: Tables):
    rows = bundles.day_partition(t.view("bus_hits").withColumn("ingest_ts", F.timestamp_micros("us")))
    return rows.select("event_id", F.col("day").cast("string").alias("day"))


@query(
    "write_daily",
    """SELECT strftime(make_timestamp(us), '%Y%m%d') AS day, 'events.' || strftime(make_timestamp(us), '%Y%m%d') AS name,
              count(*) AS n, cast(sum(strlen(body)) AS BIGINT) AS n_bytes FROM bus_hits GROUP BY ALL""",
    ("bus_hits",),
)
def write_daily(t: Tables):
    """Daily directories written and read back."""
    path = t.scratch("daily")
    rows = t.view("bus_hits").select(F.timestamp_micros("us").alias("ingest_ts"), F.col("body").alias("value"))
    sinks.write_daily(rows, path)
    found = t.spark.read.schema("value string, day string").text(path)
    name = F.concat(F.lit("events."), F.col("day"))
    return found.groupBy("day", name.alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value").cast("bigint")).alias("n_bytes")
    )


@query(
    "write_compressed",
    """SELECT codec, ext, count(*) AS n, cast(sum(strlen(body)) AS BIGINT) AS n_bytes FROM bus_hits,
         (VALUES ('gzip', '.gz'), ('lz4', '.lz4'), ('none', '.txt')) AS c(codec, ext) GROUP BY codec, ext""",
    ("bus_hits",),
)
def write_compressed(t: Tables):
    """Each codec written and read back, with the extension that its files bear."""
    rows = t.view("bus_hits").select(F.col("body").alias("value"))
    read = []
    for codec in ("gzip", "lz4", "none"):
        path = t.scratch(f"codec-{codec}")
        sinks.write_compressed(rows, path, codec)
        read.append(
            t.spark.read.text(path).select("value", F.regexp_extract("_metadata.file_name", r"(\.[a-z0-9]+)$", 1).alias("ext")).groupBy("ext").agg(
                F.lit(codec).alias("codec"), F.count(F.lit(1)).alias("n"),
                F.sum(F.octet_length("value").cast("bigint")).alias("n_bytes"),
            )
        )
    return filters.union_sources(*read)


# ---- packing ---------------------------------------------------------------------------------------------------------


def packing_ctes(limit: int, mode: str, worker: str = "0") -> str:
    """Sequential packing per source and worker as a recursive query: ``r(source, w, doc_id, rn, cur, b)``."""
    if mode == bundles.GREEDY:
        opens = f"r.cur + m.len > {limit}"
    else:
        opens = f"r.cur >= {limit}"
    return f"""m AS (SELECT source, {worker} AS w, doc_id, strlen(value) AS len,
               row_number() OVER (PARTITION BY source, {worker} ORDER BY doc_id) AS rn
        FROM messages WHERE value <> ''),
    r AS (SELECT source, w, doc_id, rn, len AS cur, 0::BIGINT AS b FROM m WHERE rn = 1
          UNION ALL SELECT m.source, m.w, m.doc_id, m.rn, CASE WHEN {opens} THEN m.len ELSE r.cur + m.len END,
                           CASE WHEN {opens} THEN b + 1 ELSE b END
          FROM r JOIN m ON m.source = r.source AND m.w = r.w AND m.rn = r.rn + 1)"""


def packed(t: Tables, mode: str = bundles.GREEDY, limit: int = MAX_BYTES, **options):
    rows = filters.nonempty_filter(t.view("messages"))
    return bundles.pack_bundles(rows, "source", "doc_id", limit, mode, **options)


@query(
    "pack_bundles", "SELECT source, doc_id, b AS bundle_no FROM r", ("messages",), packing_ctes(MAX_BYTES, "greedy"), True
)
def pack_bundles(t: Tables):
    return packed(t).select("source", "doc_id", "bundle_no")


@query(
    "pack_bundles_fill", "SELECT source, doc_id, b AS bundle_no FROM r", ("messages",), packing_ctes(MAX_BYTES, "fill"), True
)
def pack_bundles_fill(t: Tables):
    return packed(t, bundles.FILL).select("source", "doc_id", "bundle_no")


@query(
    "pack_bundles_segments", "SELECT source, doc_id, b AS bundle_no FROM r", ("messages",), packing_ctes(MAX_BYTES, "greedy"), True
)
def pack_bundles_segments(t: Tables):
    """The same packing with keys cut into several segments, as happens to a large key."""
    return packed(t, rows_per_segment=100).select("source", "doc_id", "bundle_no")


@query(
    "write_chunks",
    """SELECT source, b AS chunk_no, 'out/events.' || source || '.2024-01-01T00:00:00.000-' || cast(b % 2 AS VARCHAR) || '.json' AS object_key,
              count(*) AS n, cast(sum(strlen(value)) AS BIGINT) AS n_bytes
       FROM r JOIN messages USING (source, doc_id) GROUP BY ALL""",
    ("messages",), packing_ctes(CHUNK_BYTES, "fill"), True,
)
def write_chunks(t: Tables):
    """Chunks written and read back, with the object name each would get."""
    path = t.scratch("chunks")
    sinks.write_chunks(t.view("messages"), path, "source", "doc_id", CHUNK_BYTES)
    found = sinks.read_files(t.spark, path, "value string, source string, chunk_no bigint")
    grouped = found.groupBy("source", "chunk_no").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value").cast("bigint")).alias("n_bytes")
    )
    name = F.concat(F.lit("events."), F.col("source"))
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return grouped.withColumn("object_key", bundles.chunk_key(name, stamp, F.col("chunk_no") % 2, "out"))


OBJECT_BYTES, OBJECT_SECONDS = 30_000, 100_000


@query(
    "write_objects",
    """SELECT event_type, b AS chunk_no, 'events.' || event_type || '.' || strftime(make_timestamp(opened), '%Y-%m-%dT%H:%M:%S.%g')
              || '-' || cast(b % 3 AS VARCHAR) || '.json' AS object, count(*) AS n, cast(sum(len) AS BIGINT) AS n_bytes,
              md5(string_agg(body, chr(10) ORDER BY rn)) AS digest
       FROM r GROUP BY ALL""",
    ("bus_hits",),
    f"""m AS (SELECT event_type, us, body, strlen(body) AS len, row_number() OVER (PARTITION BY event_type ORDER BY us, event_id) AS rn
        FROM bus_hits),
    r AS (SELECT event_type, us, body, len, rn, len AS cur, us AS opened, 0::BIGINT AS b FROM m WHERE rn = 1
          UNION ALL
          SELECT m.event_type, m.us, m.body, m.len, m.rn, CASE WHEN ends THEN m.len ELSE r.cur + m.len END,
                 CASE WHEN ends THEN m.us ELSE r.opened END, CASE WHEN ends THEN b + 1 ELSE b END
          FROM r JOIN m ON m.event_type = r.event_type AND m.rn = r.rn + 1,
               LATERAL (SELECT r.cur >= {OBJECT_BYTES} OR m.us >= r.opened + {OBJECT_SECONDS}000000 AS ends) AS e)""",
    True,
)
def write_objects(t: Tables):
    """Chunks closed by size or age, whichever comes first; names, records and their order as written."""
    path = t.scratch("objects")
    hits = t.view("bus_hits").select("event_type", "event_id", F.timestamp_micros("us").alias("ts"), F.col("body").alias("value"))
    sinks.write_objects(hits, path, "event_type", "event_id", OBJECT_BYTES, "ts", OBJECT_SECONDS, prefix="out", workers=3)
    found = sinks.read_files(t.spark, path, "value string, event_type string, chunk_no bigint, object string", wholetext=True)
    body = F.rtrim(F.col("value"), F.lit("\n"))
    n = F.size(F.split(body, "\n")).cast("bigint")
    return found.select("event_type", "chunk_no", "object", n.alias("n"), (F.octet_length(body) - n + 1).cast("bigint").alias("n_bytes"), F.md5(body).alias("digest"))


@query(
    "event_seq",
    "SELECT source, doc_id, b AS bundle_no, row_number() OVER (PARTITION BY source, b ORDER BY doc_id) - 1 AS event_seq FROM r",
    ("messages",), packing_ctes(MAX_BYTES, "greedy"), True,
)
def event_seq(t: Tables):
    rows = bundles.event_seq(packed(t), ["source", "bundle_no"], "doc_id")
    return rows.select("source", "doc_id", "bundle_no", "event_seq")


@query(
    "bundle_summary",
    """SELECT source, b AS bundle_no, count(*) AS n_events, cast(sum(strlen(value)) AS BIGINT) AS n_bytes
       FROM r JOIN messages USING (source, doc_id) GROUP BY ALL""",
    ("messages",), packing_ctes(MAX_BYTES, "greedy"), True,
)
def bundle_summary(t: Tables):
    return bundles.bundle_summary(packed(t), ["source", "bundle_no"])


def _payload_sql(events: str, head: str, tail: str) -> str:
    return f"""SELECT source, bundle_no, n AS n_events, md5({head} || events || {tail}) AS digest FROM (
        SELECT source, b AS bundle_no, count(*) AS n, {events} AS events FROM r JOIN messages USING (source, doc_id) GROUP BY ALL)"""


HTTP_HEAD = """'{"filename": "' || source || '-' || cast(bundle_no AS VARCHAR) || '", "service": "telemetry", "alerts":['"""
PAYLOAD = dict(reads=("messages",), ctes=packing_ctes(MAX_BYTES, "greedy"), recursive=True)


def _digest(df):
    return df.select("source", "bundle_no", "n_events", F.md5("payload").alias("digest"))


@query("http_payload", _payload_sql("string_agg(value, chr(10) || ', ' ORDER BY doc_id)", HTTP_HEAD, "']}'"), **PAYLOAD)
def http_payload(t: Tables):
    return _digest(bundles.http_payload(packed(t), ["source", "bundle_no"], "doc_id", service="telemetry"))


@query(
    "http_payload_base64",
    """SELECT source, bundle_no, n AS n_events, md5(events) AS digest FROM (
         SELECT source, bundle_no, count(*) AS n, string_agg(to_base64(encode(CASE WHEN seq = 1 THEN value ELSE chr(10) || ', ' || value END)),
                '' ORDER BY doc_id) AS events
         FROM (SELECT source, doc_id, b AS bundle_no, value, row_number() OVER (PARTITION BY source, b ORDER BY doc_id) AS seq
               FROM r JOIN messages USING (source, doc_id)) GROUP BY ALL)""",
    **PAYLOAD,
)
def http_payload_base64(t: Tables):
    rows = bundles.http_payload(packed(t), ["source", "bundle_no"], "doc_id", template="{events}", as_base64=True)
    return _digest(rows)


@query("http_payload_leef", _payload_sql("string_agg(value || chr(10), '' ORDER BY doc_id)", "''", "''"), **PAYLOAD)
def http_payload_leef(t: Tables):
    return _digest(bundles.http_payload(packed(t), ["source", "bundle_no"], "doc_id", leef=True))


POST_TEMPLATE = """{{/* a body with its size and numbered events */ -}}
<post name="{{.FileName}}" size="{{.FileSize}}">{{range .Events}}{{if .EventSeq}};{{else}}first {{end -}}
  {{.EventSeq}}@{{$.FileName}}={{.EventText}}{{else}}none{{end}}{{- `</post>` }}"""


@query(
    "http_payload_template",
    """SELECT source, bundle_no, n AS n_events, md5('<post name="' || name || '" size="' || cast(n_bytes AS VARCHAR) || '">' || events || '</post>') AS digest
       FROM (SELECT source, bundle_no, name, count(*) AS n, cast(sum(strlen(value) + 1) AS BIGINT) AS n_bytes,
                    string_agg(CASE seq WHEN 0 THEN 'first ' ELSE ';' END || cast(seq AS VARCHAR) || '@' || name || '=' || value || chr(10), '' ORDER BY seq) AS events
             FROM (SELECT source, b AS bundle_no, source || '-' || cast(b AS VARCHAR) AS name, value,
                          row_number() OVER (PARTITION BY source, b ORDER BY doc_id) - 1 AS seq FROM r JOIN messages USING (source, doc_id))
             GROUP BY source, bundle_no, name)""",
    **PAYLOAD,
)
def http_payload_template(t: Tables):
    """A template with the bundle's name and size, a range over events, their numbers and a choice by number."""
    rows = bundles.http_payload(packed(t), ["source", "bundle_no"], "doc_id", post_template=POST_TEMPLATE, comma_separate=False)
    return _digest(rows)


@query(
    "splunk_payload",
    _payload_sql("""string_agg('{"sourcetype":"telemetry:json","event":' || value || '}', '' ORDER BY doc_id)""", "''", "''"),
    **PAYLOAD,
)
def splunk_payload(t: Tables):
    return _digest(bundles.splunk_payload(packed(t), ["source", "bundle_no"], "doc_id", sourcetype="telemetry:json"))


WINDOW = "us // 300000000 * 300"


@query(
    "time_bundles",
    f"""SELECT {WINDOW} AS start_s, count(*) AS n_events, cast(sum(strlen(body)) AS BIGINT) AS n_bytes FROM bus_hits GROUP BY ALL""",
    ("bus_hits",),
)
def time_bundles(t: Tables):
    rows = t.view("bus_hits").withColumn("ingest_ts", F.timestamp_micros("us"))
    return _starts(bundles.time_bundles(rows, "5 minutes", text="body"))


@query(
    "time_bundles_with_empty",
    f"""SELECT s AS start_s, coalesce(n, 0) AS n_events, coalesce(b, 0) AS n_bytes
        FROM (SELECT unnest(range(lo, hi + 1, 300)) AS s FROM (SELECT min({WINDOW}) AS lo, max({WINDOW}) AS hi FROM bus_hits))
        LEFT JOIN (SELECT {WINDOW} AS w, count(*) AS n, cast(sum(strlen(body)) AS BIGINT) AS b FROM bus_hits GROUP BY ALL) ON w = s""",
    ("bus_hits",),
)
def time_bundles_with_empty(t: Tables):
    rows = t.view("bus_hits").withColumn("ingest_ts", F.timestamp_micros("us"))
    return _starts(bundles.time_bundles(rows, "5 minutes", text="body", keep_empty=True))


def _starts(df):
    return df.select(F.unix_seconds("bundle_start").alias("start_s"), "n_events", "n_bytes")


# ---- counters --------------------------------------------------------------------------------------------------------


@query(
    "count_by_routing_key",
    f"""SELECT CASE WHEN exchange = '{RAW_EXCHANGE}' THEN exchange ELSE routing_key END AS routing_key, count(*) AS n
        FROM bus_hits GROUP BY ALL""",
    ("bus_hits",),
)
def count_by_routing_key(t: Tables):
    return stats.count_by_routing_key(t.view("bus_hits"))


@query(
    "count_by_mime_key",
    "SELECT content_type || '/' || routing_key AS mime_key, count(*) AS n FROM bus_bad GROUP BY ALL",
    ("bus_bad",),
)
def count_by_mime_key(t: Tables):
    return stats.count_by_mime_key(t.view("bus_bad"))


@query(
    "throughput_stats",
    f"""SELECT count(*) AS input_events, cast(sum(strlen(body)) AS BIGINT) AS input_bytes,
               count(*) FILTER ({IS_OBJECT}) AS output_events, cast(sum(CASE WHEN {IS_OBJECT} THEN strlen(body) END) AS BIGINT) AS output_bytes,
               count(*) FILTER (NOT {IS_OBJECT}) AS errors FROM bus_bad""",
    ("bus_bad",),
)
def throughput_stats(t: Tables):
    return stats.throughput_stats(encode.encode_json(filters.parse_json_body(t.view("bus_bad"))))


@query(
    "rate_stats",
    """SELECT routing_key, n AS n_events, b AS n_bytes, cast(floor(n * 1e6 / span * 1000) AS BIGINT) AS milli_events_per_s,
              cast(floor(b * 1e6 / span * 1000) AS BIGINT) AS milli_bytes_per_s
       FROM (SELECT routing_key, count(*) AS n, cast(sum(strlen(body)) AS BIGINT) AS b, max(us) - min(us) AS span FROM bus_hits GROUP BY ALL)""",
    ("bus_hits",),
)
def rate_stats(t: Tables):
    rows = t.view("bus_hits").withColumn("ingest_ts", F.timestamp_micros("us"))
    return _milli(stats.rate_stats(rows, by=["routing_key"]), "routing_key")


@query(
    "rate_stats_windowed",
    """SELECT us // 3600000000 * 3600 AS start_s, count(*) AS n_events, cast(sum(strlen(body)) AS BIGINT) AS n_bytes,
              cast(floor(count(*) * 1e6 / 3600000000 * 1000) AS BIGINT) AS milli_events_per_s,
              cast(floor(cast(sum(strlen(body)) AS BIGINT) * 1e6 / 3600000000 * 1000) AS BIGINT) AS milli_bytes_per_s
       FROM bus_hits GROUP BY ALL""",
    ("bus_hits",),
)
def rate_stats_windowed(t: Tables):
    rows = t.view("bus_hits").withColumn("ingest_ts", F.timestamp_micros("us"))
    return _milli(stats.rate_stats(rows, every="1 hour"), F.unix_seconds("window_start").alias("start_s"))


def _milli(df, key):
    scaled = lambda c: F.floor(F.col(c) * 1000).cast("bigint").alias(f"milli_{c}")
    return df.select(key, "n_events", "n_bytes", scaled("events_per_s"), scaled("bytes_per_s"))


@query(
    "throughput_observed",
    f"""SELECT count(*) AS input_events, cast(sum(strlen(body)) AS BIGINT) AS input_bytes,
               count(*) FILTER ({IS_OBJECT}) AS output_events, cast(sum(CASE WHEN {IS_OBJECT} THEN strlen(body) END) AS BIGINT) AS output_bytes,
               count(*) FILTER (NOT {IS_OBJECT}) AS errors FROM bus_bad""",
    ("bus_bad",),
)
def throughput_observed(t: Tables):
    """The same figures, reported by the job that writes the events."""
    seen = Observation("throughput")
    rows = stats.observed(encode.encode_json(filters.parse_json_body(t.view("bus_bad"))), seen)
    sinks.write_text(filters.nonempty_filter(rows).select("value"), t.scratch("observed"))
    figures = seen.get
    schema = ", ".join(f"{name} bigint" for name in figures)
    return t.spark.createDataFrame([tuple(figures.values())], schema)


METER_SQL = "sum({amount} * CASE WHEN s = a THEN 1 ELSE 1 - exp(-5 / 60.0 / {m}) END * exp((s - {e}) * 5 / 60.0 / {m}) / 5)"


def _meter_columns(end: str) -> list[tuple[str, str]]:
    """Name and SQL of every moving rate, read at the end of the tick ``end``."""
    amounts = {"events": "1", "bytes": "strlen(body)"}
    return [(f"{n}_per_s_{m}m", METER_SQL.format(amount=x, m=m, e=end)) for n, x in amounts.items() for m in meters.MINUTES]


def _micro(df, *keys):
    """Rates in millionths, rounded."""
    rates = [c for c in df.columns if "_per_s" in c]
    return df.select(*keys, *[F.floor(F.col(c) * 1e6 + 0.5).cast("bigint").alias(c) for c in rates])


def _micro_sql(columns) -> str:
    return ", ".join(f"cast(floor({sql} * 1e6 + 0.5) AS BIGINT) AS {name}" for name, sql in columns)


@query(
    "rate_meters",
    f"""SELECT routing_key, count(*) AS n_events, cast(sum(strlen(body)) AS BIGINT) AS n_bytes,
               {_micro_sql([("events_per_s", "(count(*) / ((any_value(b) - any_value(a) + 1) * 5.0))"),
                            ("bytes_per_s", "(sum(strlen(body)) / ((any_value(b) - any_value(a) + 1) * 5.0))"), *_meter_columns("b")])}
        FROM (SELECT *, us // 5000000 AS s FROM bus_hits), (SELECT min(us) // 5000000 AS a, max(us) // 5000000 AS b FROM bus_hits)
        GROUP BY routing_key""",
    ("bus_hits",),
)
def rate_meters(t: Tables):
    """Mean and moving rates per routing key at the end of the last tick."""
    rows = t.view("bus_hits").withColumn("ingest_ts", F.timestamp_micros("us"))
    return _micro(meters.meters(rows, by=["routing_key"]), "routing_key", "n_events", "n_bytes")


@query(
    "rate_meter_readings",
    f"""SELECT r.routing_key, (r.slot + 1) * 3600 AS read_s, any_value(r.n) AS n_events, {_micro_sql(_meter_columns("(r.slot * 720 + 719)"))}
        FROM (SELECT routing_key, us // 3600000000 AS slot, count(*) AS n FROM bus_hits GROUP BY ALL) AS r
        JOIN (SELECT routing_key, body, us // 5000000 AS s, us // 3600000000 AS slot FROM bus_hits) AS h
          ON h.routing_key = r.routing_key AND h.slot <= r.slot AND h.slot > r.slot - 24,
        (SELECT min(us) // 5000000 AS a FROM bus_hits)
        GROUP BY r.routing_key, r.slot""",
    ("bus_hits",),
)
def rate_meter_readings(t: Tables):
    """Moving rates per routing key at the end of every hour with events."""
    rows = t.view("bus_hits").withColumn("ingest_ts", F.timestamp_micros("us"))
    found = meters.meter_readings(rows, by=["routing_key"])
    return _micro(found, "routing_key", F.unix_seconds("read_at").alias("read_s"), "n_events")


@query(
    "delivery_stats",
    """SELECT dest, count(*) FILTER (status = 200) AS sent, count(*) FILTER (status = 400) AS dropped,
              count(*) FILTER (status <> 200) AS upload_errors,
              arg_max(error_text, (attempt_s, bundle_id)) FILTER (status <> 200) AS last_error_text,
              max(attempt_s) FILTER (status <> 200) AS last_error_s, max(attempt_s) FILTER (status = 200) AS last_success_s
       FROM deliveries GROUP BY dest""",
    ("deliveries",),
)
def delivery_stats(t: Tables):
    return stats.delivery_stats(t.view("deliveries"))


@query(
    "dropped_since_reconnect",
    """SELECT dest, first_drop, dropped FROM (
         SELECT dest, seen, min(bundle_id) AS first_drop, count(*) AS dropped FROM (
           SELECT dest, bundle_id, status, sum(CASE WHEN status = 200 THEN 1 ELSE 0 END) OVER (PARTITION BY dest ORDER BY bundle_id) AS seen
           FROM deliveries) WHERE status <> 200 GROUP BY dest, seen)""",
    ("deliveries",),
)
def dropped_since_reconnect(t: Tables):
    rows = t.view("deliveries").withColumn("connected", F.col("status") == 200)
    return stats.dropped_since_reconnect(rows, "dest", "bundle_id", rows_per_segment=100_000)


@query(
    "avg_processing_time",
    """SELECT event_type, count(*) AS n, cast(round(avg(cast(round(value * 100) AS BIGINT)) * 1000) AS BIGINT) AS avg_time
       FROM events GROUP BY event_type""",
)
def avg_processing_time(t: Tables):
    rows = t.view("events").withColumn("took", F.round(F.col("value") * 100).cast("bigint"))
    found = stats.avg_processing_time(rows, "took", ["event_type"])
    return found.withColumn("avg_time", F.round(F.col("avg_time") * 1000).cast("bigint"))


# ---- comparison ------------------------------------------------------------------------------------------------------

PRICE = "cast(o_custkey AS VARCHAR)"


@query(
    "diff_tables",
    f"""SELECT file, line, '' AS path, 'missing' AS problem, gold AS gold_value, NULL::VARCHAR AS new_value FROM two_outputs WHERE line % 11 = 0
        UNION ALL SELECT file, line, '.price', 'value', {PRICE}, cast(o_custkey + 1 AS VARCHAR) FROM two_outputs WHERE line % 11 <> 0 AND line % 7 = 0
        UNION ALL SELECT file, line, '.price', 'type', {PRICE}, {PRICE} FROM two_outputs WHERE line % 11 <> 0 AND line % 7 <> 0 AND line % 19 = 0
        UNION ALL SELECT file, line, '.s', 'missing', o_orderstatus, NULL FROM two_outputs WHERE line % 11 <> 0 AND line % 17 = 0
        UNION ALL SELECT file, line, '.a', 'length', '2', '1' FROM two_outputs WHERE line % 11 <> 0 AND line % 23 = 0
        UNION ALL SELECT file, line, '.extra', 'extra', NULL, 'true' FROM two_outputs WHERE line % 11 <> 0 AND line % 13 = 0""",
    ("two_outputs",),
)
def diff_tables(t: Tables):
    both = t.view("two_outputs")
    gold = both.select("file", "line", F.col("gold").alias("value"))
    new = both.filter("new is not null").select("file", "line", F.col("new").alias("value"))
    return diff.diff_tables(gold, new, ["file", "line"])


@query("diff_tables_equal", "SELECT file, line, '' AS path FROM two_outputs WHERE false", ("two_outputs",))
def diff_tables_equal(t: Tables):
    """A table does not differ from itself, nor from the same objects with their keys in another order."""
    rows = t.view("two_outputs").select("file", "line", F.col("gold").alias("value"))
    resorted = rows.withColumn("value", F.to_json(F.try_parse_json("value")))
    return diff.diff_tables(rows, resorted, ["file", "line"]).select("file", "line", "path")


@query("only_in_gold", "SELECT file, line FROM two_outputs WHERE new IS NULL AND line % 5 <> 0", ("two_outputs",))
def only_in_gold(t: Tables):
    gold, new = _two_sides(t)
    return diff.only_in_gold(gold, new, ["file", "line"])


@query("only_in_new", "SELECT file, line FROM two_outputs WHERE new IS NOT NULL AND line % 5 = 0", ("two_outputs",))
def only_in_new(t: Tables):
    gold, new = _two_sides(t)
    return diff.only_in_new(gold, new, ["file", "line"])


def _two_sides(t: Tables):
    both = t.view("two_outputs")
    return both.filter("line % 5 <> 0"), both.filter("new is not null")


# ---- delivery --------------------------------------------------------------------------------------------------------


@query(
    "delivery_ledger",
    """SELECT o_custkey AS bundle_id, count(*) AS attempts,
              coalesce(arg_max(CASE status WHEN 200 THEN 'done' ELSE 'quarantined' END, (attempt_s, bundle_id)) FILTER (status IN (200, 400)), 'retry') AS outcome,
              max(attempt_s) AS last_attempt FROM deliveries GROUP BY o_custkey""",
    ("deliveries",),
)
def delivery_ledger(t: Tables):
    """All orders of a customer taken as attempts for one bundle."""
    attempts = t.view("deliveries").select(
        F.col("o_custkey").alias("bundle_id"), "status", F.struct("attempt_s", "bundle_id").alias("at")
    )
    found = delivery.delivery_ledger(attempts, when="at")
    return found.select("bundle_id", "attempts", "outcome", F.col("last_attempt.attempt_s").alias("last_attempt"))


@query("pending", "SELECT bundle_id, dest FROM deliveries WHERE status NOT IN (200, 400)", ("deliveries",))
def pending(t: Tables):
    """Bundles to be sent again: those no attempt of the ledger has closed."""
    attempts = t.view("deliveries")
    return delivery.pending(attempts.select("bundle_id", "dest"), delivery.delivery_ledger(attempts))


def post_stub(body: bytes, headers: dict[str, str]) -> tuple[int, str | None]:
    """Endpoint for checks: refuses by the length of the body."""
    kind = len(body) % 4
    return (200, None) if kind > 1 else (400, "bad request") if kind == 1 else (503, "busy")


@query(
    "deliver",
    f"""SELECT source || '-' || cast(bundle_no AS VARCHAR) AS bundle_id, status,
               CASE status WHEN 200 THEN 'done' WHEN 400 THEN 'quarantined' ELSE 'retry' END AS outcome
        FROM (SELECT source, bundle_no, CASE n % 4 WHEN 0 THEN 503 WHEN 1 THEN 400 ELSE 200 END AS status
              FROM (SELECT source, b AS bundle_no, cast(sum(strlen(value) + 1) AS BIGINT) AS n FROM r JOIN messages USING (source, doc_id) GROUP BY ALL))""",
    **PAYLOAD,
)
def deliver(t: Tables):
    """Packed records sent to a stub endpoint through the executors."""
    bodies = bundles.http_payload(packed(t), ["source", "bundle_no"], "doc_id", leef=True)
    named = bodies.withColumn("bundle_id", F.concat_ws("-", "source", "bundle_no"))
    return delivery.deliver(named, post_stub).select("bundle_id", "status", "outcome")


ROUNDS = 3


def post_in_round(number: int):
    """Endpoint that is back for a payload, a decimal number, in the round ``payload % 4``; the last digit 7 is refused."""

    def post(body: bytes, headers: dict[str, str]) -> tuple[int, str | None]:
        value = int(body)
        if value % 10 == 7:
            return 400, "bad request"
        return (200, None) if value % 4 <= number else (503, "busy")

    return post


@query(
    "deliver_pending",
    f"""SELECT cast(bundle_id AS VARCHAR) AS bundle_id, CASE WHEN o_custkey % 10 = 7 THEN 1 ELSE least(o_custkey % 4 + 1, {ROUNDS}) END AS attempts,
               CASE WHEN o_custkey % 10 = 7 THEN 'quarantined' WHEN o_custkey % 4 < {ROUNDS} THEN 'done' ELSE 'retry' END AS outcome
        FROM deliveries""",
    ("deliveries",),
)
def deliver_pending(t: Tables):
    """Three rounds over one ledger: each sends what no earlier round has closed."""
    rows = t.view("deliveries").select("bundle_id", F.col("o_custkey").cast("string").alias("payload"))
    path = t.scratch("ledger")
    for number in range(ROUNDS):
        ledger = delivery.deliver_pending(t.spark, rows, path, post_in_round(number))
    return delivery.delivery_ledger(ledger, when="attempt_ts").select("bundle_id", "attempts", "outcome")
