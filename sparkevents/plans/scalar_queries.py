"""Queries over the scalar rules and binary input."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import frames
from .carriers import Duck, guid_sql
from .registry import Tables, query
from .sensor_queries import _little_endian, _seconds, _swap, frame_bytes


@query(
    "make_guid",
    f"SELECT event_id, {guid_sql(Duck, 'user_id - 100', 'event_id - 5000', 'win')} AS guid FROM sensor_flat",
    ("sensor_flat",),
)
def make_guid(t: Tables):
    c = F.col
    return t.view("sensor_flat").select("event_id", S.make_guid(c("user_id") - 100, c("event_id") - 5000, c("win")).alias("guid"))


@query(
    "unix_time",
    f"""SELECT event_id, {_seconds("h_ts")} AS seconds, CASE WHEN h_ts = 0 THEN 0 ELSE cast(floor(((h_ts / 10000.0::DOUBLE)
               - 11644473600000.0::DOUBLE) / 1000.0::DOUBLE * 1000) AS BIGINT) END AS millis FROM sensor_flat""",
    ("sensor_flat",),
)
def unix_time(t: Tables):
    ticks = F.col("h_ts")
    return t.view("sensor_flat").select(
        "event_id", S.unix_seconds(ticks).alias("seconds"), F.floor(S.unix_seconds_float(ticks) * 1000).cast("bigint").alias("millis")
    )


@query(
    "ip_text",
    f"""SELECT c_custkey, {_little_endian("v4")} AS little, """
    + " || '.' || ".join(f"cast(((v4 - 2147483648) >> {s}) & 255 AS VARCHAR)" for s in (24, 16, 8, 0))
    + f""" AS big, {_swap("port")} AS port FROM ips""",
    ("ips",),
)
def ip_text(t: Tables):
    c = F.col
    return t.view("ips").select(
        "c_custkey", S.ipv4_little_endian(c("v4")).alias("little"), S.ipv4_big_endian(c("v4") - 2147483648).alias("big"),
        S.ntohs(c("port")).alias("port"),
    )


# Shapes of IPv6 addresses by shape = c_custkey % 7, as 8 groups; x and y are two numbers of the row.
V6_GROUPS = {
    0: ("0", "0", "0", "0", "0", "0", "0", "0"),
    1: ("0", "0", "0", "0", "0", "0", "0", "x"),
    2: ("x", "0", "0", "y", "0", "0", "0", "1"),
    3: ("x", "0", "y", "0", "x", "0", "y", "0"),
    4: ("x", "y", "0", "0", "y", "x", "0", "0"),
    5: ("0", "0", "0", "0", "0", "65535", "x", "y"),
    6: ("x", "y", "x", "y", "x", "y", "x", "y"),
}
V6_TEXT = {
    0: "'::'",
    1: "'::' || X",
    2: "X || ':0:0:' || Y || '::1'",
    3: "X || ':0:' || Y || ':0:' || X || ':0:' || Y || ':0'",
    4: "X || ':' || Y || '::' || Y || ':' || X || ':0:0'",
    5: "'::ffff'",
    6: "X || ':' || Y || ':' || X || ':' || Y || ':' || X || ':' || Y || ':' || X || ':' || Y",
}


def _v6_sql() -> str:
    shown = {k: v.replace("X", "printf('%x', x)").replace("Y", "printf('%x', y)") for k, v in V6_TEXT.items()}
    dotted = " || '.' || ".join(f"cast(({g} >> {s}) & 255 AS VARCHAR)" for g, s in (("x", 8), ("x", 0), ("y", 8), ("y", 0)))
    shown[5] = dotted
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in shown.items())
    return f"""SELECT c_custkey, CASE shape {cases} END || CASE WHEN c_custkey % 10 = 3 THEN '%en1' ELSE '' END AS address
        FROM (SELECT c_custkey, shape, cast(c_custkey % 65000 + 1 AS BIGINT) AS x, cast(port % 65000 + 1 AS BIGINT) AS y FROM ips)"""


@query("ipv6_text", _v6_sql(), ("ips",))
def ipv6_text(t: Tables):
    x, y = (F.col("c_custkey") % 65000 + 1), (F.col("port") % 65000 + 1)
    value = {"x": x, "y": y}

    def half(groups: tuple[str, ...]):
        """Little-endian number of four groups whose bytes are in network order."""
        total = F.lit(0).cast("decimal(20,0)")
        for k, g in enumerate(groups):
            number = value[g] if g in value else F.lit(int(g))
            swapped = S.ntohs(number).cast("decimal(20,0)")
            total = (total + swapped * F.lit(str(1 << (16 * k))).cast("decimal(20,0)")).cast("decimal(20,0)")
        return total

    high = low = None
    for shape, groups in V6_GROUPS.items():
        is_shape = F.col("shape") == shape
        high = F.when(is_shape, half(groups[:4])) if high is None else high.when(is_shape, half(groups[:4]))
        low = F.when(is_shape, half(groups[4:])) if low is None else low.when(is_shape, half(groups[4:]))
    scope = F.when(F.col("c_custkey") % 10 == 3, F.lit("en1"))
    rows = t.view("ips").select("c_custkey", high.alias("high"), low.alias("low"), scope.alias("scope"))
    return rows.select("c_custkey", S.ipv6_text(F.col("high"), F.col("low"), F.col("scope")).alias("address"))


@query(
    "text_rules",
    """SELECT doc_id, upper(md5(text)) AS body_md5, to_base64(encode(source || text)) AS base64_text, upper(hex(source)) AS hex_digest,
              'f-' || source || '-' || cast(doc_id AS VARCHAR) || '.json' AS name FROM documents""",
)
def text_rules(t: Tables):
    c = F.col
    return t.view("documents").select(
        "doc_id", S.body_md5(c("text")).alias("body_md5"), S.event_text(F.concat("source", "text"), True).alias("base64_text"),
        S.hex_digest(c("source").cast("binary")).alias("hex_digest"),
        S.fill_template("f-{source}-{id}.json", source=c("source"), id=c("doc_id")).alias("name"),
    )


@query(
    "first_query_value",
    """SELECT page_id, url_decode(replace(regexp_extract(url, '[?&]page=([^&#]*)', 1), '+', ' ')) AS page
       FROM pages WHERE regexp_matches(url, '[?&]page=')""",
)
def first_query_value(t: Tables):
    rows = t.view("pages").select("page_id", F.regexp_extract("url", r"\?([^#]*)", 1).alias("qs"))
    return rows.select("page_id", S.first_query_value(F.col("qs"), "page").alias("page")).filter("page is not null")


@query(
    "header_int",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS sensor_id FROM events""",
)
def header_int(t: Tables):
    raw = F.when(F.col("event_id") % 5 == 0, F.lit("7x")).otherwise(F.col("user_id").cast("string"))
    rows = t.view("events").select("event_id", F.create_map(F.lit("sensorId"), raw).alias("h"))
    return rows.select("event_id", S.header_int(F.col("h"), "sensorId").alias("sensor_id"))


# ---- binary bundles --------------------------------------------------------------------------------------------------

RUN_SQL = """SELECT event_id, i AS idx, 'payload ' || cast(event_id AS VARCHAR) || ' ' || cast(i AS VARCHAR) AS frame, NULL::VARCHAR AS error
    FROM events, LATERAL (SELECT unnest(range(0, event_id % 4)) AS i) AS u WHERE event_id % 10 <> 7
    UNION ALL SELECT event_id, event_id % 4, NULL, 'messages did not fill entire bundle' FROM events WHERE event_id % 10 = 3
    UNION ALL SELECT event_id, 0, NULL, 'body is shorter than 4 bytes' FROM events
              WHERE event_id % 10 = 7 OR (event_id % 4 = 0 AND event_id % 10 NOT IN (3, 5, 7))"""


def run_bodies(t: Tables):
    """One body per event: 0 to 3 frames, then sometimes an overlong length, sometimes a few stray bytes."""
    numbers = F.sequence(F.lit(0), (F.col("event_id") % 4).cast("int"))
    payload = lambda i: F.concat_ws(" ", F.lit("payload"), F.col("event_id").cast("string"), i.cast("string")).cast("binary")
    pieces = F.transform(F.slice(numbers, F.lit(1), (F.col("event_id") % 4).cast("int")), lambda i: F.hex(frame_bytes(payload(i))))
    tail = F.when(F.col("event_id") % 10 == 3, F.lit("FFFF00000102")).when(F.col("event_id") % 10 == 5, F.lit("00000000")).otherwise("")
    body = F.when(F.col("event_id") % 10 == 7, F.unhex(F.lit("0102"))).otherwise(
        F.unhex(F.concat(F.array_join(pieces, ""), tail))
    )
    return t.view("events").select("event_id", body.alias("body"))


@query("split_frames", RUN_SQL)
def split_frames(t: Tables):
    """Frames of every body with the index, and the error of a body that does not end where a frame ends."""
    rows = frames.split_frames(run_bodies(t))
    return rows.select("event_id", "idx", F.col("frame").cast("string").alias("frame"), "error")


#: Event ids that one binary file may span, so that a file stays small however many events there are.
FILE_IDS = 10_000


def runs_of(events, groups: int):
    """Events as runs of ``bundle`` and a bounded range of ids."""
    bundle, span = (F.col("event_id") % groups).alias("bundle"), F.expr(f"event_id div {FILE_IDS}").alias("span")
    rows = events.select(bundle, span, F.col("props").cast("binary").alias("frame"), "event_id")
    return frames.pack_run(rows, ["bundle", "span"], "event_id")


#: Every frame's content and its place in its file.
FRAMES_SQL = f"""SELECT event_id % {{n}} AS bundle, md5(props) AS digest,
    row_number() OVER (PARTITION BY event_id % {{n}}, event_id // {FILE_IDS} ORDER BY event_id) - 1 AS idx FROM events"""


@query(
    "read_bundles",
    FRAMES_SQL.format(n=50),
)
def read_bundles(t: Tables):
    """Runs written as binary files by the tasks that hold them, then read back and split."""
    path = t.scratch("bundles")
    write_binary(runs_of(t.view("events"), 50).withColumn("name", F.format_string("b-%d-%d.bin", "bundle", "span")), path)
    found = frames.read_bundles(t.spark, path, "*.bin").filter("error is null")
    bundle = F.regexp_extract("path", r"b-(\d+)-\d+\.bin", 1).cast("bigint")
    return found.select(bundle.alias("bundle"), F.md5("frame").alias("digest"), "idx")


@query(
    "read_event_logs",
    FRAMES_SQL.format(n=40),
)
def read_event_logs(t: Tables):
    """The same for event logs, every second one gzipped."""
    named = runs_of(t.view("events"), 40).withColumn(
        "name", F.concat(F.format_string("e-%d-%d.log", "bundle", "span"), F.when(F.col("bundle") % 2 == 0, ".gz").otherwise(""))
    )
    path = t.scratch("logs")
    write_binary(named, path)
    found = frames.read_event_logs(t.spark, path).filter("error is null")
    bundle = F.regexp_extract("path", r"e-(\d+)-\d+\.log", 1).cast("bigint")
    return found.select(bundle.alias("bundle"), F.md5("frame").alias("digest"), "idx")


@query(
    "is_gzip",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 3 THEN NULL ELSE false END AS zipped FROM events",
)
def is_gzip(t: Tables):
    """Bodies behind the three bytes of a gzip head, behind two of them, plain and absent."""
    head = F.when(F.col("event_id") % 4 == 0, F.unhex(F.lit("1F8B08"))).when(F.col("event_id") % 4 == 1, F.unhex(F.lit("1F8B")))
    body = F.concat(F.coalesce(head, F.unhex(F.lit(""))), F.col("props").cast("binary"))
    body = F.when(F.col("event_id") % 4 != 3, body)
    return t.view("events").select("event_id", S.is_gzip(body).alias("zipped"))


def write_binary(df, path: str) -> None:
    """Write each row's ``body`` as the file ``name`` below a shared folder, from the tasks; ``.gz`` names are gzipped.

    The folder may be a path or a URI: tasks write to the file system that Spark reads it from.
    """
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    folder = store.makeQualified(place).toUri().toString()

    def write(batches):
        import gzip

        import pyarrow as pa
        from pyarrow.fs import FileSystem

        files, root = FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_output_stream(f"{root}/{name}", compression=None) as f:
                    f.write(gzip.compress(body) if name.endswith(".gz") else body)
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["name"])

    df.select("name", "body").mapInArrow(write, "name string").count()
