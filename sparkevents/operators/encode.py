"""Encoders: event -> one line of JSON or LEEF text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import variants as V
from ..functions.scalars import let

# Fixed values of the LEEF header and of the security product's normalized network field names.
LEEF_VERSION = "1.0"
VENDOR = "CB"
PRODUCT = "CB"
DEFAULT_VERSION = "5.1"
DEFAULT_TYPE = "unknown.event.type"
NETCONN_TYPE = "ingress.event.netconn"
NET_FIELDS = {
    # field: (source key when outbound, source key when inbound)
    "src": ("local_ip", "remote_ip"),
    "dst": ("remote_ip", "local_ip"),
    "proto": ("protocol", "protocol"),
    "srcPort": ("local_port", "remote_port"),
    "dstPort": ("remote_port", "local_port"),
}
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("=", "\\="))


def key_sort(m: Column) -> Column:
    """Keys of a message in byte order."""
    return F.sort_array(F.map_keys(m))


def encode_json(df: DataFrame, out: str = "value") -> DataFrame:
    """Text of each message as one JSON object with sorted keys."""
    return df.withColumn(out, N.json(V.as_object(F.col("msg"))))


def leef_escape(text: Column) -> Column:
    for raw, escaped in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def leef_render(v: Column, list_style: str = "spaced") -> Column:
    """Text of one value: '' for an empty object, JSON for an object, escaped text for strings and numbers.

    Lists print as ``[a b]`` at any depth; ``list_style='json'`` prints them as JSON instead.
    """
    return let(V.kind(v), lambda kind: _rendered(v, kind, list_style))


def _rendered(v: Column, kind: Column, list_style: str) -> Column:
    as_list = N.json(v) if list_style == "json" else N.spaced(v)
    plain = leef_escape(let(v.cast("string"), N.unmarked))
    return (
        F.when(kind.startswith("OBJECT"), F.regexp_replace(N.json(v), r"^\{\}$", ""))
        .when(kind.startswith("ARRAY"), as_list)
        .otherwise(plain)
    )


def leef_promote_docs(df: DataFrame) -> DataFrame:
    """Move the only sub-document's keys to the root, where they win; anything but one object is an error."""
    m, doc, has_docs = F.col("msg"), F.col("_doc"), F.col("_has_docs")
    # each step is a column of its own, so that nothing is computed inside of a lambda
    rows = df.withColumns({"_docs": m["docs"].try_cast("array<variant>"), "_has_docs": F.map_contains_key(m, "docs")})
    rows = rows.withColumn("_doc", F.when(F.size("_docs") == 1, V.as_message(F.get("_docs", F.lit(0)))))
    problem = F.when(has_docs & doc.isNull(), F.lit("docs is not a list of one object"))
    return rows.select(
        *[c for c in df.columns if c not in ("msg", "error")],
        F.when(has_docs, V.put(m, doc, ("docs",))).otherwise(m).alias("msg"),
        _first_error(df, problem),
    )


def _first_error(df: DataFrame, problem: Column) -> Column:
    return (F.coalesce(F.col("error"), problem) if "error" in df.columns else problem).alias("error")


def net_values(source: Column, inbound: Column) -> dict[str, Column]:
    """Normalized network fields of a message that carries local and remote ends, swapped when inbound."""
    return {
        field: F.when(inbound, source[when_in]).otherwise(source[when_out])
        for field, (when_out, when_in) in NET_FIELDS.items()
    }


def leef_net_fields(df: DataFrame) -> DataFrame:
    """Add network fields taken from ``ioc_attr`` (object or JSON text) and, for connections, from the event."""
    c, m = F.col, F.col("msg")
    inbound = lambda source: V.string_value(source["direction"]) == "inbound"
    rows = df.withColumns({
        "_attr_text": V.string_value(m["ioc_attr"]),
        "_event": F.when(V.string_value(m["type"]) == NETCONN_TYPE, m),
    })
    parsed = F.from_json(N.keep(c("_attr_text")), V.MESSAGE)
    rows = rows.withColumn("_attr", F.when(c("_attr_text").isNotNull(), parsed).otherwise(V.as_message(m["ioc_attr"])))
    rows = rows.withColumns({"_attr_in": inbound(c("_attr")), "_event_in": inbound(c("_event"))})
    from_attr, from_event = net_values(c("_attr"), c("_attr_in")), net_values(c("_event"), c("_event_in"))
    rows = rows.withColumns({f"_new_{f}": F.coalesce(from_event[f], from_attr[f]) for f in NET_FIELDS})
    rows = rows.withColumn("_set", V.value_map({f: c(f"_new_{f}") for f in NET_FIELDS}))
    problem = F.when(c("_attr_text").isNotNull() & c("_attr").isNull(), F.lit("ioc_attr is not JSON"))
    return rows.select(
        *[x for x in df.columns if x not in ("msg", "error")],
        V.put(m, c("_set"), names=tuple(NET_FIELDS)).alias("msg"),
        _first_error(df, problem),
    )


def leef_header(m: Column, vendor: str = VENDOR, product: str = PRODUCT) -> Column:
    text = lambda key: F.when(~V.kind(m[key]).rlike("^(?:OBJECT|ARRAY|BOOLEAN$)"), N.text(m[key]))
    kind = F.coalesce(text("type"), F.lit(DEFAULT_TYPE))
    kind = F.when(kind == "ingress.event.procstart", F.lit("ingress.event.process")).otherwise(kind)
    version = F.coalesce(text("cb_version"), F.lit(DEFAULT_VERSION))
    return F.concat(F.lit(f"LEEF:{LEEF_VERSION}|{vendor}|{product}|"), version, F.lit("|"), kind, F.lit("|"))


def leef_line(m: Column, list_style: str = "spaced", vendor: str = VENDOR, product: str = PRODUCT) -> Column:
    """Header and tab-joined ``key=value`` pairs in key order; JSON nulls are left out."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(e["key"], e["value"], V.kind(e["value"]).alias("kind")))
    there = F.filter(entries, lambda e: e["kind"] != "VOID")
    texts = F.transform(there, lambda e: F.struct(e["key"], _rendered(e["value"], e["kind"], list_style).alias("text")))
    pairs = F.transform(F.sort_array(texts), lambda e: F.concat(e["key"], F.lit("="), e["text"]))
    return F.concat(leef_header(m, vendor, product), F.array_join(pairs, "\t"))


def encode_leef(df: DataFrame, out: str = "value", **style: str) -> DataFrame:
    """Text of each message as one LEEF line; rows that cannot be encoded get NULL text and an ``error``."""
    rows = leef_net_fields(leef_promote_docs(df))
    return rows.withColumn(out, F.when(F.col("error").isNull(), leef_line(F.col("msg"), **style)))


def audit_json(df: DataFrame, server: str = "", out: str = "value") -> DataFrame:
    """JSON text of audit lines held in columns ``message`` and ``type``."""
    return df.withColumn(out, F.to_json(F.struct("message", "type", F.lit(server).alias("cb_server"))))
