"""Stateful packing: bundles closed by size or by age, whichever comes first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.bundles import DEFAULT_MAX_BYTES, FILL, GREEDY, starts_from

STATE = "bytes long, events long, started long, opened_ms long"
BY_SIZE, BY_AGE, EMPTY = "size", "age", "empty"


class BundlePacker(StatefulProcessor):
    """Keeps, per key, the bytes and records of the open bundle, the number of bundles started and when it started.

    Rows come in and go out without their texts. A timer of a key stands for the end of its open bundle or, if empty
    bundles are wanted, of the time without one.
    """

    def __init__(self, order: str, max_bytes: int, mode: str, max_age_ms: int | None, timers: bool,
                 keep_empty: bool, closings: bool, inputs: list[str], outputs: list[str]):
        self.order, self.max_bytes, self.mode = order, max_bytes, mode
        self.max_age_ms, self.timers, self.keep_empty, self.closings = max_age_ms, timers, keep_empty, closings
        self.inputs, self.outputs = inputs, outputs

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows))
        pdf.columns = self.inputs  # names with a leading underscore do not reach Python as they are
        pdf = pdf.sort_values(self.order, kind="stable")
        now = int(pdf["_now_ms"].iloc[0])
        known = self.open.exists()
        carry, events, started, opened = self.open.get() if known else (0, 0, 0, now)
        closed = []
        if carry and self.max_age_ms and now - opened >= self.max_age_ms:
            closed.append((started - 1, BY_AGE, events, carry))
            carry = events = 0
        prefix = np.concatenate([[0], np.cumsum(pdf["_size"].to_numpy(dtype=np.int64))])
        starts = starts_from(prefix, carry, self.max_bytes, self.mode)
        opens = np.zeros(len(pdf), np.int64)
        opens[starts] = 1
        pdf["bundle_no"] = started + np.cumsum(opens) - 1
        # what the bundles that end before each start hold, and the last one
        ends = np.append(starts, len(pdf))
        counts, sizes = np.diff(ends, prepend=0), np.diff(prefix[ends], prepend=0)
        counts[0], sizes[0] = counts[0] + events, sizes[0] + carry
        closed += [(started - 1 + i, BY_SIZE, int(counts[i]), int(sizes[i])) for i in range(len(starts)) if counts[i]]
        carry, events, started = int(sizes[-1]), int(counts[-1]), int(started + len(starts))
        if self.mode == FILL and carry >= self.max_bytes:
            closed.append((started - 1, BY_SIZE, events, carry))
            carry = events = 0
        if len(starts):
            opened = now
        self.open.update((carry, events, started, opened))
        if self.timers and (len(starts) or not known):
            self.wake(opened + self.max_age_ms)
        for name in ("closed", "n_events", "n_bytes"):
            pdf[name] = None
        yield pdf[self.outputs]
        yield from self.ended(key, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        carry, events, started, opened = self.open.get()
        if events:
            closed = [(started - 1, BY_AGE, events, carry)]
        else:
            closed = [(started, EMPTY, 0, 0)] if self.keep_empty else []
            started += len(closed)
        self.open.update((0, 0, started, opened))
        if self.keep_empty:
            self.wake(now + self.max_age_ms)
        yield from self.ended(key, closed)

    def wake(self, at: int) -> None:
        """The only timer of the key."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def ended(self, key, closed: list[tuple]) -> Iterator[pd.DataFrame]:
        if closed and self.closings:
            rows = [[*key, None, *c] for c in closed]
            yield pd.DataFrame(rows, columns=self.outputs)

    def close(self) -> None:
        pass


def stream_pack_bundles(df: DataFrame, keys: list[str], order: str, max_bytes: int = DEFAULT_MAX_BYTES,
                        mode: str = GREEDY, text: str = "value", max_age_seconds: float | None = None,
                        workers: int = 1, worker: Column | None = None, timers: bool = False, keep_empty: bool = False,
                        closings: bool = False) -> DataFrame:
    """The bundle of every record of a stream: ``keys, worker, order, bundle_no, closed, n_events, n_bytes``.

    Records of a key are packed in the order of arrival, by ``order`` inside one micro-batch. A busy key is spread over
    ``workers`` packers (by ``worker``, else by a hash of ``order``), each with bundles of its own. Only keys, order values
    and sizes go through the shuffle and the state; ``with_texts`` joins the records back. Uses the RocksDB state store.

    A bundle older than ``max_age_seconds`` takes no more records. Without timers its age is looked at when the next
    record of its key arrives, by the clock of the micro-batch, so a run over the available input comes to an end. With
    ``timers``, for a stream with a processing-time trigger, a quiet key's bundle closes by itself, and ``keep_empty``
    gives a key without records a bundle without records each time.

    ``closings`` adds a row per closed bundle: ``order`` is null, ``closed`` says why (size, age, empty), ``n_events`` and
    ``n_bytes`` what it holds. In the rows of records these three are null.
    """
    if (timers or keep_empty) and not max_age_seconds:
        raise ValueError("timers and empty bundles need max_age_seconds")
    if keep_empty and not timers:
        raise ValueError("empty bundles need timers")
    if worker is None:
        worker = F.pmod(F.xxhash64(order), F.lit(workers)).cast("int")
    rows = df.filter(F.length(text) > 0).select(
        *keys, worker.alias("worker"), order, F.octet_length(text).cast("bigint").alias("_size"),
        F.unix_millis(F.current_timestamp()).alias("_now_ms"),
    )
    known = [rows.schema[c] for c in (*keys, "worker", order)]
    added = [("bundle_no", T.LongType()), ("closed", T.StringType()), ("n_events", T.LongType()), ("n_bytes", T.LongType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in known] + [T.StructField(n, k) for n, k in added])
    age = int(max_age_seconds * 1000) if max_age_seconds else None
    packer = BundlePacker(order, max_bytes, mode, age, timers, keep_empty, closings, rows.columns, schema.names)
    return rows.groupBy(*keys, "worker").transformWithStateInPandas(
        packer, outputStructType=schema, outputMode="append", timeMode="ProcessingTime" if timers else "none"
    )


def with_texts(texts: DataFrame, packed: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The records of ``texts`` (unique in ``keys`` and ``order``) with the ``worker`` and ``bundle_no`` they were given."""
    places = packed.filter("closed IS NULL").select(*keys, order, "worker", "bundle_no")
    return texts.join(places, [*keys, order])


STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def use_rocksdb(spark) -> None:
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
