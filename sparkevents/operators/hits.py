"""Normalization of schema-less JSON hits.

A message lives in column ``msg`` (MAP<STRING, VARIANT>) beside its ``routing_key``. Each rule states which keys it
sets as a dict of key -> VARIANT column (NULL leaves the key alone). Rules read the message through a ``Reads`` object,
which turns what they read and share into columns of their own, so a value is taken out of the map once however many
rules use it. ``normalize_hits`` merges the dicts of all rules and rebuilds the map once: a message is parsed once,
rewritten once and never leaves its partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import scalars as S
from ..functions import variants as V

ALWAYS_DROPPED = ("highlights",)
MD5_KEYS = ("md5", "parent_md5", "process_md5")
IP_KEYS = ("comms_ip", "interface_ip")

Values = dict[str, Column]


class Reads:
    """Columns the rules need before they can state their values: parts of the message, then shared results."""

    def __init__(self, message: str):
        self.message = message
        self.parts: dict[str, Column] = {}
        self.texts: dict[str, Column] = {}
        self.shared: list[dict[str, Column]] = []

    def _part(self, kind: str, key: str, take: Callable[[Column], Column]) -> Column:
        name = f"_{kind}_{key}"
        self.parts.setdefault(name, take(F.col(self.message)[key]))
        return F.col(name)

    def text(self, key: str) -> Column:
        self.texts.setdefault(f"_text_{key}", N.unmarked_string(self._part("held", key, V.marked_string)))
        return F.col(f"_text_{key}")

    def int32(self, key: str) -> Column:
        return self._part("int32", key, V.int32_value)

    def value(self, key: str) -> Column:
        return self._part("value", key, lambda v: v)

    def share(self, **results: Column) -> list[Column]:
        """Results that several rules or values use; they may build on everything read or shared before."""
        known = {name for step in self.shared for name in step}
        self.shared.append({f"_{name}": c for name, c in results.items() if f"_{name}" not in known})
        return [F.col(f"_{name}") for name in results]

    def columns(self, df: DataFrame) -> DataFrame:
        for results in filter(None, [self.parts, self.texts, *self.shared]):
            df = df.withColumns(results)
        return df


Rule = Callable[[Reads], Values]


def apply_rules(df: DataFrame, rules: list[Rule], removed: tuple[str, ...] = (), message: str = "msg",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Rewrite a message column by a set of rules; ``keep`` names keys no rule may set."""
    reads = Reads(message)
    values: Values = {}
    for rule in rules:
        values |= rule(reads)
    values = {k: v for k, v in values.items() if k not in keep}
    if not values:
        return df.withColumn(message, V.without(F.col(message), removed))
    ready = reads.columns(df).withColumns({f"_new_{k}": v for k, v in values.items()})
    ready = ready.withColumn("_set", V.value_map({k: F.col(f"_new_{k}") for k in values}))
    rewritten = V.put(F.col(message), F.col("_set"), removed, tuple(values))
    return ready.select(*[rewritten.alias(message) if c == message else F.col(c) for c in df.columns])


# ---- rules: message -> values to set -------------------------------------------------------------------------------


def hit_type(routing_key: Column) -> Column:
    """Event type of a routing key: ``feed.<digits>.X`` reads as ``feed.X``."""
    return F.regexp_replace(routing_key, r"^feed\.(\d+)\.(.*)$", "feed.$2")


def type_rule(r: Reads) -> Values:
    return {"type": V.variant(hit_type(F.col("routing_key")))}


def timestamp_rule(r: Reads) -> Values:
    return {"timestamp": r.value("event_timestamp")}


def hostname_rule(r: Reads) -> Values:
    return {"computer_name": r.value("hostname")}


def _if_md5(text: Column, result: Column) -> Column:
    return F.when(F.octet_length(text) == 32, result)


def md5_rule(r: Reads) -> Values:
    return {k: _if_md5(r.text(k), V.variant(S.upper(r.text(k)))) for k in MD5_KEYS}


def ioc_type_rule(r: Reads) -> Values:
    """An object-valued ``ioc_type`` gets its text ``md5`` upper-cased, whatever its length."""
    ioc = r.value("ioc_type")
    (inner,) = r.share(ioc_object=V.as_message(ioc))
    (md5,) = r.share(ioc_md5=V.string_value(inner["md5"]))
    fixed = V.as_object(V.assign(inner, "md5", V.variant(S.upper(md5))))
    return {"ioc_type": F.when(md5.isNotNull(), fixed)}


def ioc_query_rule(r: Reads) -> Values:
    """Index and decoded query text of a query-type indicator; nothing at all when any part is malformed."""
    raw = F.when(r.text("ioc_type") == "query", r.text("ioc_value"))
    (inner,) = r.share(ioc_members=F.from_json(raw, V.MESSAGE))
    index, search = r.share(
        ioc_index=F.when(F.map_contains_key(inner, "index_type"), S.or_empty(V.string_value(inner["index_type"]))),
        ioc_search=V.string_value(inner["search_query"]),
    )
    all_text = F.forall(F.map_values(inner), lambda v: V.kind(v).isin("STRING", "VOID"))
    (query,) = r.share(ioc_query=F.when(all_text & index.isNotNull(), S.first_query_value(search, "q")))
    return {
        "ioc_query_index": F.when(query.isNotNull(), V.variant(index)),
        "ioc_query_string": V.variant(query),
    }


def ip_rule(r: Reads) -> Values:
    return {k: V.variant(S.ipv4_big_endian(r.int32(k))) for k in IP_KEYS}


def full_guid(text: Column) -> tuple[Column, Column, Column]:
    """``(guid, segment, ok)`` of an identifier that may carry a hexadecimal segment after its 36 characters."""
    n = F.octet_length(text)
    tail = F.substring(text, 38, 12)
    is_hex = tail.rlike("^[0-9A-Fa-f]+$")
    with_segment = n.isin(45, 49)
    guid = F.when(n < 36, text).otherwise(F.substring(text, 1, 36))
    segment = (
        F.when(with_segment & is_hex, F.conv(tail, 16, 10)).when(n == 49, F.lit("0")).otherwise(F.lit("1"))
    )
    ok = (n == 36) | (with_segment & is_hex)
    return guid, F.when(text.isNotNull(), segment), ok


def process_guid_texts(r: Reads) -> Values:
    """Process identifier and segment from a well-formed ``unique_id`` (not for alerts), else from ``process_id``."""
    unique = F.when(~F.col("routing_key").startswith("alert."), r.text("unique_id"))
    _, _, ok = full_guid(unique)
    (source,) = r.share(process_source=F.when(ok, unique).otherwise(r.text("process_id")))
    guid, segment, _ = full_guid(source)
    guid, segment = r.share(process_guid_text=guid, segment_id_text=segment)
    return {"process_guid": guid, "segment_id": segment}


def parent_guid_texts(r: Reads) -> Values:
    guid, segment, _ = full_guid(r.text("parent_unique_id"))
    guid, segment = r.share(parent_guid_text=guid, parent_segment_id_text=segment)
    return {"parent_guid": guid, "parent_segment_id": segment}


def process_guid_rule(r: Reads) -> Values:
    return {k: V.variant(c) for k, c in process_guid_texts(r).items()}


def parent_guid_rule(r: Reads) -> Values:
    return {k: V.variant(c) for k, c in parent_guid_texts(r).items()}


def link_rule(base_url: str, fresh: bool = False) -> Rule:
    """Deep links from what the message holds; with ``fresh``, from what the other rules are about to set."""
    base_url = normalize_url(base_url)
    url = lambda *parts: V.variant(F.concat(F.lit(base_url), *parts))

    def links(r: Reads) -> Values:
        new: Values = {}
        if fresh:
            new = {**process_guid_texts(r), **parent_guid_texts(r)}
        text = lambda key: F.coalesce(*([new[key]] if key in new else []), N.text(r.value(key)))
        values = {"link_sensor": url(F.lit("#/host/"), r.int32("sensor_id").cast("string"))}
        for key in MD5_KEYS:
            shown = S.upper(r.text(key)) if fresh else r.text(key)
            values[f"link_{key}"] = _if_md5(r.text(key), url(F.lit("#/binary/"), shown))
        for link, guid, segment, default in (
            ("link_process", "process_guid", "segment_id", "0"),
            ("link_parent", "parent_guid", "parent_segment_id", "1"),
        ):
            values[link] = url(F.lit("#analyze/"), text(guid), F.lit("/"), F.coalesce(text(segment), F.lit(default)))
        return values

    return links


def server_rule(server: str) -> Rule:
    return lambda r: {"cb_server": V.variant(F.lit(server))}


def normalize_url(base_url: str) -> str:
    """Base url as used in links: trimmed, ending in one slash; '' turns links off."""
    base_url = base_url.strip()
    return base_url if not base_url or base_url.endswith("/") else base_url + "/"


def message_rules(base_url: str = "") -> list[Rule]:
    """Rules that hold for a root message and for every sub-document."""
    rules = [
        timestamp_rule, hostname_rule, md5_rule, ioc_type_rule, ioc_query_rule, ip_rule, process_guid_rule,
        parent_guid_rule,
    ]
    return [*rules, link_rule(base_url, fresh=True)] if base_url else rules


# ---- operators -----------------------------------------------------------------------------------------------------


def fix_type(df: DataFrame) -> DataFrame:
    return apply_rules(df, [type_rule])


def rename_timestamp(df: DataFrame) -> DataFrame:
    return apply_rules(df, [timestamp_rule], ("event_timestamp",))


def copy_hostname(df: DataFrame) -> DataFrame:
    return apply_rules(df, [hostname_rule])


def upper_md5(df: DataFrame) -> DataFrame:
    return apply_rules(df, [md5_rule])


def fix_ioc_type_map(df: DataFrame) -> DataFrame:
    return apply_rules(df, [ioc_type_rule])


def parse_ioc_query(df: DataFrame) -> DataFrame:
    return apply_rules(df, [ioc_query_rule])


def fix_ip(df: DataFrame) -> DataFrame:
    return apply_rules(df, [ip_rule])


def process_guid_segment(df: DataFrame) -> DataFrame:
    return apply_rules(df, [process_guid_rule])


def parent_guid_segment(df: DataFrame) -> DataFrame:
    return apply_rules(df, [parent_guid_rule])


def add_links(df: DataFrame, base_url: str) -> DataFrame:
    return apply_rules(df, [link_rule(base_url)]) if normalize_url(base_url) else df


def add_server(df: DataFrame, server: str) -> DataFrame:
    return apply_rules(df, [server_rule(server)])


def drop_keys(df: DataFrame, keys: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Remove named keys, and always ``highlights``, from every message."""
    return apply_rules(df, [], (*ALWAYS_DROPPED, *(k.strip() for k in keys)))


def explode_docs(df: DataFrame, fix: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per element of ``docs``; each keeps the root fields and holds that element alone in ``docs``.

    An empty array gives no row, a message without the key gives one. ``fix`` rewrites the documents, which it finds
    in column ``_doc``. ``doc_pos`` is the element's position, NULL without ``docs``. A message whose ``docs`` is no
    array gives one row, an element that is no object its row, without ``msg`` and with the reason in ``error``.
    """
    found = df.withColumn("_docs", F.col("msg")["docs"].try_cast("array<variant>"))
    is_array = F.col("_docs").isNotNull()
    elements = F.coalesce("_docs", F.array(F.lit(None).cast("variant")))
    bad_docs = F.map_contains_key(F.col("msg"), "docs") & ~is_array
    # a row holds its own document only: the others stay behind before the message is repeated
    kinds = found.withColumns({"msg": V.without(F.col("msg"), ("docs",)), "_bad_docs": bad_docs, "_in_array": is_array})
    rows = kinds.select("*", F.posexplode(elements).alias("doc_pos", "_element")).drop("_docs")
    rows = rows.withColumn("_doc", V.as_message(F.col("_element"))).withColumn("_there", F.col("_doc").isNotNull())
    rows = (fix(rows) if fix else rows).withColumn("_wrapped", V.as_object(F.array("_doc")))
    there = F.col("_there")
    one = F.map_concat(F.col("msg"), F.create_map(F.lit("docs"), F.col("_wrapped")))
    previous = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    wrong = F.when(F.col("_bad_docs"), "docs is not an array").when(
        F.col("_in_array") & ~there, "element of docs is not an object"
    )
    return rows.select(
        *[c for c in df.columns if c not in ("msg", "error")],
        F.when(F.col("_in_array"), F.col("doc_pos")).alias("doc_pos"),
        F.when(wrong.isNotNull(), None).when(there, one).otherwise(F.col("msg")).alias("msg"),
        F.coalesce(previous, wrong).alias("error"),
    )


def normalize_hits(df: DataFrame, server: str = "", base_url: str = "", drop: tuple[str, ...] = ()) -> DataFrame:
    """Whole hit path over parsed messages: fix the root, name type and server, explode and fix every document.

    ``drop`` names further keys to remove from roots and documents.
    """
    rules = message_rules(base_url)
    removed = (*ALWAYS_DROPPED, "event_timestamp", *drop)
    root = apply_rules(df, [*rules, type_rule, server_rule(server)], removed, keep=drop)
    return explode_docs(root, lambda rows: apply_rules(rows, rules, removed, "_doc", keep=drop))
