"""Counters and rates. Every aggregate is algebraic, so Spark combines it before the shuffle and hot keys stay cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .filters import RAW_EXCHANGE
from .ordered import ROWS_PER_SEGMENT, running


def count_by_routing_key(df: DataFrame, raw_exchange: str = RAW_EXCHANGE) -> DataFrame:
    """Events per routing key; everything from the raw exchange counts under the exchange's name."""
    key = F.when(F.col("exchange") == raw_exchange, raw_exchange).otherwise(F.col("routing_key"))
    return df.groupBy(key.alias("routing_key")).agg(F.count(F.lit(1)).alias("n"))


def count_by_mime_key(df: DataFrame) -> DataFrame:
    """Events per ``<content type>/<routing key>``."""
    return df.groupBy(F.concat_ws("/", "content_type", "routing_key").alias("mime_key")).agg(
        F.count(F.lit(1)).alias("n")
    )


def size_of(c: str | Column) -> Column:
    return F.octet_length(c).cast("bigint")


def throughput_columns(body: str = "body", value: str = "value", error: str = "error") -> list[Column]:
    """Input and output events and bytes, and errors, as aggregates: for ``agg`` or ``observe``."""
    has_output = F.length(value) > 0
    zero = F.lit(0).cast("bigint")
    return [
        F.count(F.lit(1)).alias("input_events"),
        F.coalesce(F.sum(size_of(body)), zero).alias("input_bytes"),
        F.count_if(has_output).alias("output_events"),
        F.coalesce(F.sum(F.when(has_output, size_of(value))), zero).alias("output_bytes"),
        F.count(F.col(error)).alias("errors"),
    ]


def throughput_stats(df: DataFrame, **columns: str) -> DataFrame:
    return df.agg(*throughput_columns(**columns))


def rate_stats(df: DataFrame, ts: str = "ingest_ts", body: str = "body", by: list[str] | None = None,
               every: str | None = None) -> DataFrame:
    """Mean events and bytes per second between the first and the last event, per key and/or time window.

    Inside a window the rate is over the window's own length.
    """
    keys: list = list(by or [])
    if every:
        keys.append(F.window(ts, every).alias("w"))
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(size_of(body)).alias("n_bytes"),
        (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))).alias("span_us"),
    )
    if every:
        grouped = grouped.select(
            *(by or []),
            F.col("w.start").alias("window_start"),
            "n_events",
            "n_bytes",
            (F.unix_micros("w.end") - F.unix_micros("w.start")).alias("span_us"),
        )
    per_second = lambda c: F.when(F.col("span_us") > 0, F.col(c) * F.lit(1e6) / F.col("span_us"))
    return grouped.withColumn("events_per_s", per_second("n_events")).withColumn("bytes_per_s", per_second("n_bytes"))


def delivery_stats(df: DataFrame) -> DataFrame:
    """Per destination: sent, dropped and failed counts, last error with its time, last success.

    Input columns: ``dest, status, error_text, attempt_s, bundle_id``. Equal times are decided by the bundle id.
    """
    sent = F.col("status") == 200
    failed = ~sent
    when = F.struct("attempt_s", "bundle_id")
    return df.groupBy("dest").agg(
        F.count_if(sent).alias("sent"),
        F.count_if(F.col("status") == 400).alias("dropped"),
        F.count_if(failed).alias("upload_errors"),
        F.max_by(F.when(failed, F.col("error_text")), F.when(failed, when)).alias("last_error_text"),
        F.max(F.when(failed, F.col("attempt_s"))).alias("last_error_s"),
        F.max(F.when(sent, F.col("attempt_s"))).alias("last_success_s"),
    )


def dropped_since_reconnect(df: DataFrame, dest: str = "dest", order: str = "seq", connected: str = "connected",
                            rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """Drops between two connections of a destination: one row per run of events that met no connection."""
    # All drops of a run have seen the same number of connected events.
    numbered = running(df, [dest], order, {"_seen": F.col(connected).cast("bigint")}, rows_per_segment)
    drops = numbered.filter(~F.col(connected)).groupBy(dest, "_seen").agg(
        F.count(F.lit(1)).alias("dropped"), F.min(order).alias("first_drop")
    )
    return drops.select(dest, "first_drop", "dropped")


def avg_processing_time(df: DataFrame, took: str, by: list[str] | None = None) -> DataFrame:
    """Mean and count of a timing column."""
    return df.groupBy(*(by or [])).agg(F.count(took).alias("n"), F.avg(took).alias("avg_time"))



def observed(df: DataFrame, name: str | Observation, **columns: str) -> DataFrame:
    """``df`` that reports ``throughput_stats`` of the rows passing by, without a second pass over them.

    A batch hands them to an ``Observation`` once an action has run; a stream reports them per micro-batch under ``name``.
    """
    return df.observe(name, *throughput_columns(**columns))
