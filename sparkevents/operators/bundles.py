"""Grouping text records into bundles by size and time.

Size packing is a sequential rule: whether a record opens a new bundle depends on all records before it. It still runs
in parallel. The rule's state at any point is one number, the bytes already in the open bundle, so each (key, segment)
first answers "for every possible number of carried bytes: how many bundles start here, and what is carried on?".
Only the records of the first bundle's worth of bytes can make a difference, which keeps that answer small. A short
scan over the answers of a key's segments then fixes what each segment really receives, and every segment lists its
bundle starts. Records are never moved through Python: a running window carries the number of the last start to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import event_text, fill_template
from ..functions.structs import arrow_schema
from ..session import shared_dir
from .ordered import ROWS_PER_SEGMENT, as_number, segment_of, split_points
from .templates import Node, compiled, parse

GREEDY = "greedy"
FILL = "fill"
DEFAULT_MAX_BYTES = 10 * 1024 * 1024
DEFAULT_EVERY = "5 minutes"


# ---- the packing rule on one ordered run of record sizes -------------------------------------------------------------


def first_start(prefix: np.ndarray, room, mode: str):
    """Index of the first record that opens a new bundle when ``room`` bytes are left in the open one."""
    if mode == GREEDY:
        return np.maximum(np.searchsorted(prefix, room, side="right") - 1, 0)
    return np.minimum(np.searchsorted(prefix, room, side="left"), len(prefix) - 1)


def next_starts(prefix: np.ndarray, limit: int, mode: str) -> np.ndarray:
    """For a bundle opened at each record: where the following bundle opens (the record count if it stays open)."""
    n = len(prefix) - 1
    return np.maximum(first_start(prefix, prefix[:-1] + limit, mode), np.arange(1, n + 1))


def carried(prefix: np.ndarray, last: np.ndarray, limit: int, mode: str) -> np.ndarray:
    """Bytes in the bundle opened at ``last`` at the end of the run; 0 when the rule has already closed it."""
    size = prefix[-1] - prefix[last]
    return np.where(size >= limit, 0, size) if mode == FILL else size


def starts_from(prefix: np.ndarray, carry: int, limit: int, mode: str) -> np.ndarray:
    """Indexes of all records that open a bundle, given the bytes carried into the run (0: no open bundle)."""
    n = len(prefix) - 1
    at = 0 if carry == 0 else int(first_start(prefix, limit - carry, mode))
    if carry and mode == FILL and prefix[at] < limit - carry:
        at = n
    following = next_starts(prefix, limit, mode)
    found = []
    while at < n:
        found.append(at)
        at = int(following[at])
    return np.array(found, dtype=np.int64)


def answers(prefix: np.ndarray, limit: int, mode: str) -> dict[str, list]:
    """What a run does for every number of carried bytes, as ranges of the room left in the open bundle.

    ``room_from`` ascends; the last range whose start is not above the room applies. ``carry_out`` is -1 where the
    whole run fits into the open bundle, which then carries on with the run's bytes added.
    """
    n = len(prefix) - 1
    following = next_starts(prefix, limit, mode)
    count = np.ones(n, dtype=np.int64)
    jump = following.copy()
    last = np.arange(n)
    while (jump < n).any():  # pointer doubling over the chain of bundle starts
        live = np.flatnonzero(jump < n)
        target = jump[live]
        count[live] += count[target]
        last[live] = last[target]
        jump[live] = jump[target]
    carry = carried(prefix, last, limit, mode)
    if mode == GREEDY:
        reach = int(np.searchsorted(prefix, limit, side="right"))
        entries = np.arange(min(reach, n + 1))
        room_from = prefix[entries].copy()
        room_from[:1] = np.iinfo(np.int64).min
    else:
        entries = np.arange(0, min(int(np.searchsorted(prefix, limit, side="left")), n) + 1)
        room_from = np.concatenate([[np.iinfo(np.int64).min], prefix[entries[:-1]] + 1]) if len(entries) else prefix[:0]
        if entries[-1] == n and prefix[n] < limit:
            entries = np.append(entries, n + 1)
            room_from = np.append(room_from, prefix[n] + 1)
    new, out = np.zeros(len(entries), np.int64), np.zeros(len(entries), np.int64)
    inside = entries < n
    new[inside], out[inside] = count[entries[inside]], carry[entries[inside]]
    stays_open = entries == n if mode == GREEDY else entries == n + 1
    out[stays_open] = -1
    keep = np.ones(len(entries), bool)
    keep[1:] = (np.diff(new) != 0) | (np.diff(out) != 0)
    return {
        "room_from": room_from[keep].tolist(),
        "new_bundles": new[keep].tolist(),
        "carry_out": out[keep].tolist(),
        "bytes": int(prefix[-1]),
        "fresh_bundles": int(count[0]) if n else 0,
        "fresh_carry": int(carry[0]) if n else 0,
    }


def _prefix(table: pa.Table, order: str) -> tuple[np.ndarray, np.ndarray]:
    """Row order by the order column, and byte sums before each record in that order."""
    position = np.asarray(pa.compute.sort_indices(table, sort_keys=[(order, "ascending")]))
    sizes = table.column("_size").to_numpy().astype(np.int64)[position]
    return position, np.concatenate([[0], np.cumsum(sizes)])


# ---- the distributed packing -----------------------------------------------------------------------------------------


def _summaries(narrow: DataFrame, keys: list[str], order: str, limit: int, mode: str) -> DataFrame:
    schema = T.StructType(
        [narrow.schema[k] for k in (*keys, "_segment")]
        + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("room_from", "new_bundles", "carry_out")]
        + [T.StructField(n, T.LongType()) for n in ("bytes", "fresh_bundles", "fresh_carry")]
    )

    def summarize(table: pa.Table) -> pa.Table:
        _, prefix = _prefix(table, order)
        row = {k: table.column(k)[0].as_py() for k in (*keys, "_segment")} | answers(prefix, limit, mode)
        return pa.Table.from_pylist([row], schema=arrow_schema(schema))

    return narrow.groupBy(*keys, "_segment").applyInArrow(summarize, schema)


def _entries(summaries: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """What each segment receives: carried bytes and the number of bundles started before it."""
    schema = T.StructType(
        [summaries.schema[k] for k in (*keys, "_segment")]
        + [T.StructField(n, T.LongType()) for n in ("_carry", "_before")]
    )

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_segment")
        carry, before, carries, befores = 0, 0, [], []
        for row in pdf.itertuples():
            carries.append(carry)
            befores.append(before)
            if carry == 0:
                before, carry = before + row.fresh_bundles, row.fresh_carry
                continue
            at = int(np.searchsorted(row.room_from, limit - carry, side="right")) - 1
            before += int(row.new_bundles[at])
            carry = carry + row.bytes if row.carry_out[at] == -1 else int(row.carry_out[at])
        return pdf[[*keys, "_segment"]].assign(_carry=carries, _before=befores)

    return summaries.groupBy(*keys).applyInPandas(scan, schema)


def _starts(narrow: DataFrame, keys: list[str], order: str, limit: int, mode: str) -> DataFrame:
    """One row per bundle start: key, segment, order value and the bundle's number. A segment whose first records belong
    to a bundle of an earlier one begins with a row for that bundle."""
    schema = T.StructType(
        [narrow.schema[k] for k in (*keys, "_segment", order)] + [T.StructField("_number", T.LongType())]
    )

    def list_starts(table: pa.Table) -> pa.Table:
        position, prefix = _prefix(table, order)
        found = starts_from(prefix, table.column("_carry")[0].as_py(), limit, mode)
        number = table.column("_before")[0].as_py() + np.arange(len(found))
        if not len(found) or found[0]:
            found, number = np.append(0, found), np.append(table.column("_before")[0].as_py() - 1, number)
        at = table.take(pa.array(position[found])).select([*keys, "_segment", order])
        return at.append_column("_number", pa.array(number, pa.int64())).cast(arrow_schema(schema))

    return narrow.groupBy(*keys, "_segment").applyInArrow(list_starts, schema)


def pack_bundles(df: DataFrame, key: str | list[str], order: str, max_bytes: int = DEFAULT_MAX_BYTES,
                 mode: str = GREEDY, text: str = "value", out: str = "bundle_no",
                 rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """Add the 0-based number, within its key, of the bundle every record belongs to.

    ``greedy`` opens a new bundle for the record that would take the open one past ``max_bytes`` (a larger record gets
    a bundle of its own); ``fill`` closes a bundle after the record that makes it reach ``max_bytes``. Sizes are UTF-8
    bytes. ``order`` is a number or time that is unique within a key. Empty records must be filtered out before.
    """
    if mode not in (GREEDY, FILL):
        raise ValueError(f"unknown packing mode {mode}")
    keys = [key] if isinstance(key, str) else list(key)
    # sizes are read several times, so they are written once; the records themselves pass a single time
    path = shared_dir(df.sparkSession, "packing")
    sized = df.select(*keys, order, F.octet_length(text).cast("bigint").alias("_size"))
    sized.write.parquet(path)
    sized = df.sparkSession.read.schema(sized.schema).parquet(path)
    points = split_points(sized, order, rows_per_segment)
    segment = segment_of(as_number(df, order), points)
    narrow = sized.withColumn("_segment", segment)
    entries = _entries(_summaries(narrow, keys, order, max_bytes, mode), keys, max_bytes)
    entries = entries.select(*[F.col(k).alias(f"_k_{k}") for k in (*keys, "_segment")], "_carry", "_before")
    narrow = narrow.join(entries, _matches(keys), "inner").select(*narrow.columns, "_carry", "_before")
    # starts stand before the record of the same order value; each record takes the number of the last one before it
    starts = _starts(narrow, keys, order, max_bytes, mode).withColumn("_record", F.lit(False))
    marked = df.withColumns({"_segment": segment, "_record": F.lit(True)}).unionByName(starts, allowMissingColumns=True)
    earlier = Window.partitionBy(*keys, "_segment").orderBy(order, "_record")
    number = F.last("_number", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn(out, number).filter("_record").select(*df.columns, out)


def _matches(keys: list[str]) -> Column:
    condition = F.col("_segment") == F.col("_k__segment")
    for k in keys:
        condition &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return condition


# ---- numbering, time and summaries -----------------------------------------------------------------------------------


def event_seq(df: DataFrame, bundle: str | list[str], order: str, text: str = "value", out: str = "event_seq") -> DataFrame:
    """0-based number of each non-empty event inside its bundle; a bundle's size is bounded by packing."""
    bundle = [bundle] if isinstance(bundle, str) else list(bundle)
    return df.filter(F.length(text) > 0).withColumn(
        out, F.row_number().over(Window.partitionBy(*bundle).orderBy(order)).cast("bigint") - 1
    )


def time_bundles(df: DataFrame, every: str = DEFAULT_EVERY, ts: str = "ingest_ts", text: str = "value",
                 keep_empty: bool = False) -> DataFrame:
    """Events and bytes per time bundle, optionally with the empty ones between the first and the last."""
    counted = (
        df.groupBy(F.window(ts, every).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.octet_length(text).cast("bigint")).alias("n_bytes"))
        .select(F.col("w.start").alias("bundle_start"), "n_events", "n_bytes")
    )
    if not keep_empty:
        return counted
    width = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {every}"))
    none = F.lit(0).cast("bigint")
    empty = _gaps(counted.select((F.unix_micros("bundle_start") / width).cast("bigint").alias("slot")))
    empty = empty.select(F.timestamp_micros(F.col("slot") * width).alias("bundle_start"), none.alias("n_events"), none.alias("n_bytes"))
    return counted.unionByName(empty)


def _gaps(occupied: DataFrame, block: int = 4096, run: int = 10_000) -> DataFrame:
    """The numbers missing between the smallest and the largest ``slot``.

    Each slot looks for its successor in its block, the last one of a block takes the first of the next block. Gaps are cut
    into runs of bounded length before they are listed, so a clock that is years off is spread over tasks.
    """
    slots = occupied.withColumn("block", F.floor(F.col("slot") / block))
    firsts = slots.groupBy("block").agg(F.min("slot").alias("first"))
    firsts = firsts.select("block", F.lead("first").over(Window.orderBy("block")).alias("behind"))  # a row per block
    inside = F.lead("slot").over(Window.partitionBy("block").orderBy("slot"))
    after = slots.withColumn("next", inside).join(firsts, "block").select("slot", F.coalesce("next", "behind").alias("next"))
    gaps = after.filter(F.col("next") > F.col("slot") + 1)
    runs = gaps.select(F.explode(F.sequence(F.col("slot") + 1, F.col("next") - 1, F.lit(run).cast("bigint"))).alias("begin"), "next")
    runs = runs.repartition("begin")
    return runs.select(F.explode(F.sequence("begin", F.least(F.col("begin") + run - 1, F.col("next") - 1))).alias("slot"))


def bundle_summary(df: DataFrame, bundle: list[str], text: str = "value") -> DataFrame:
    """Events and bytes per bundle."""
    return df.groupBy(*bundle).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.octet_length(text).cast("bigint")).alias("n_bytes")
    )


def day_partition(df: DataFrame, ts: str = "ingest_ts", out: str = "day") -> DataFrame:
    return df.withColumn(out, F.to_date(ts))


def chunk_key(name: Column, stamp: Column, worker: Column, prefix: str | None = None, extension: str = ".json") -> Column:
    """Object name ``[prefix/]name.<yyyy-MM-ddTHH:mm:ss.SSS>-<worker><extension>``."""
    base = F.concat(F.lit(f"{prefix}/"), name) if prefix else name
    stamp_text = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return F.concat(base, F.lit("."), stamp_text, F.lit("-"), worker.cast("string"), F.lit(extension))


# ---- request bodies --------------------------------------------------------------------------------------------------

EVENT_MARK = "{events}"


def payloads(df: DataFrame, bundle: list[str], order: str, template: str | tuple[Node, ...], separator: str = "",
             terminator: str = "", wrap: tuple[str, str] = ("", ""), file_name: Column | None = None, as_base64: bool = False,
             text: str = "value", out: str = "payload") -> DataFrame:
    """One request body per bundle.

    ``template`` may hold ``{filename}`` and ``{events}``, or is a parsed post template (``templates.parse``), whose file
    size is that of the bundle's lines. ``separator`` goes in front of all events but the first and ``terminator`` after
    each; both are part of the text that ``as_base64`` encodes. ``wrap`` goes around the result.
    """
    rows = event_seq(df, bundle, order, text)
    event = F.when(F.col("event_seq") > 0, F.concat(F.lit(separator), F.col(text))).otherwise(F.col(text))
    event = event_text(F.concat(event, F.lit(terminator)), as_base64)
    event = F.concat(F.lit(wrap[0]), event, F.lit(wrap[1]))
    collected = rows.groupBy(*bundle).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.array_sort(F.collect_list(F.struct("event_seq", event.alias("text")))).alias("_events"),
        F.sum(F.octet_length(text).cast("bigint") + 1).alias("_size"),
    )
    name = file_name if file_name is not None else F.concat_ws("-", *[F.col(b).cast("string") for b in bundle])
    if not isinstance(template, str):
        body = compiled(template, F.col("_events"), FileName=name, FileSize=F.col("_size"))
        return collected.select(*bundle, "n_events", body.alias(out))
    events = F.array_join(F.transform("_events", lambda e: e["text"]), "")
    return collected.select(*bundle, "n_events", fill_template(template, filename=name, events=events).alias(out))


def http_payload(df: DataFrame, bundle: list[str], order: str, service: str = "events", template: str | None = None,
                 leef: bool = False, post_template: str | None = None, comma_separate: bool | None = None, **options) -> DataFrame:
    """Request bodies for a web endpoint: a JSON object with an ``alerts`` list, or plain lines for LEEF.

    ``post_template`` is a template with ``{{...}}`` actions instead. Its events have a comma and a line break in front, as
    in the default, or a line break behind where ``comma_separate`` is off, as it is for LEEF.
    """
    if post_template is not None:
        marks = {"separator": "\n, "} if (not leef if comma_separate is None else comma_separate) else {"terminator": "\n"}
        return payloads(df, bundle, order, parse(post_template), **marks, **options)
    if leef:
        return payloads(df, bundle, order, template or EVENT_MARK, terminator="\n", **options)
    default = '{"filename": "{filename}", "service": "' + service + '", "alerts":[{events}]}'
    return payloads(df, bundle, order, template or default, separator="\n, ", **options)


def splunk_payload(df: DataFrame, bundle: list[str], order: str, sourcetype: str = "events:json", **options) -> DataFrame:
    """Request bodies for an event collector: one wrapped object per event, nothing in between."""
    return payloads(df, bundle, order, EVENT_MARK, wrap=('{"sourcetype":"' + sourcetype + '","event":', "}"), **options)
