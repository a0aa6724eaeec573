"""Streams built from the same narrow functions as the batch plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import encode, filters, hits, stats
from ..operators.delivery import PostFn, deliver_batch
from ..sources.envelope import replay


def stream_normalize(messages: DataFrame, patterns: list[str], server: str = "", base_url: str = "", fmt: str = "json") -> DataFrame:
    """Envelope stream (or table) to encoded events: subscribe, parse, normalize, encode. No state, no shuffle."""
    routed = filters.dispatch_content_type(filters.subscribe_filter(messages, patterns))
    parsed = filters.parse_json_body(routed.filter(F.col("route") == "json"))
    good = parsed.filter(F.col("error").isNull()).drop("error", "body", "route")
    events = filters.reject_errors(hits.normalize_hits(good, server, base_url))[0]
    # an encoded object is never empty, so nothing is left to be filtered behind the encoder
    return encode.encode_json(events) if fmt == "json" else encode.encode_leef(events)


def stream_counts(messages: DataFrame) -> DataFrame:
    """Live counters per routing key; write in ``complete`` or ``update`` mode."""
    return stats.count_by_routing_key(messages)


def stream_rates(messages: DataFrame, every: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Byte and event rates per window of event time, late data dropped after ``late``."""
    return stats.rate_stats(messages.withWatermark("ingest_ts", late), every=every)


class Throughput(StreamingQueryListener):
    """Totals of the metrics that a stream made with ``stats.observed`` reports, over its micro-batches.

    Add it with ``spark.streams.addListener`` before the stream starts. It keeps a number a metric on the driver; reports
    arrive shortly after their batch, and a batch that ran again is counted once.
    """

    def __init__(self, name: str):
        self.name, self.totals, self.latest = name, {}, {}

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is None or progress.batchId <= self.latest.get(progress.id, -1):
            return
        self.latest[progress.id] = progress.batchId
        for metric, value in row.asDict().items():
            self.totals[metric] = self.totals.get(metric, 0) + (value or 0)

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


def stream_replay_files(messages: DataFrame, n: int) -> DataFrame:
    """File stream in which every message is sent ``n`` times."""
    return replay(messages, n)


def stream_daily_sink(events: DataFrame, path: str, checkpoint: str, ts: str = "ingest_ts", **trigger) -> StreamingQuery:
    """Write encoded events to one directory per calendar day; exactly once through the file sink's log."""
    rows = filters.nonempty_filter(events).select(F.col("value"), F.date_format(ts, "yyyyMMdd").alias("day"))
    return (
        rows.writeStream.format("text")
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def stream_deliver(bundles: DataFrame, ledger_path: str, checkpoint: str, post_fn: PostFn, **trigger) -> StreamingQuery:
    """Send every bundle of a stream that the ledger does not list as closed, batch by batch; bundles whose sending
    failed go along with each later batch until they are closed."""

    def send(batch: DataFrame, number: int) -> None:
        deliver_batch(batch.sparkSession, batch, ledger_path, post_fn, number)

    return (
        bundles.writeStream.foreachBatch(send)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drain a stream into parquet below ``path`` and read it back."""
    spark = stream.sparkSession
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").outputMode("append").start(path)
    else:
        query = writer.outputMode(mode).foreachBatch(replace_table(path)).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def replace_table(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write

