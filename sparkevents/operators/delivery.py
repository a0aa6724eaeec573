"""Delivery of bundles to an injected endpoint, with a ledger of outcomes."""

from __future__ import annotations

import gzip
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.structs import arrow_schema

DONE = "done"
QUARANTINED = "quarantined"
RETRY = "retry"

PostFn = Callable[[bytes, dict[str, str]], tuple[int, str | None]]

LEDGER = "bundle_id string, attempt_ts timestamp, status int, error_text string, outcome string"


def outcome(status: Column) -> Column:
    """200 is done, 400 is a permanent fault of the data, everything else is tried again."""
    return F.when(status == 200, DONE).when(status == 400, QUARANTINED).otherwise(RETRY)


def delivery_ledger(attempts: DataFrame, bundle: str = "bundle_id", when: str = "attempt_s") -> DataFrame:
    """Last state per bundle over all attempts; a done or quarantined bundle stays so."""
    final = F.col("_outcome") != RETRY
    rows = attempts.withColumn("_outcome", outcome(F.col("status")))
    return rows.groupBy(bundle).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.coalesce(
            F.max_by(F.when(final, F.col("_outcome")), F.when(final, F.col(when))), F.lit(RETRY)
        ).alias("outcome"),
        F.max(when).alias("last_attempt"),
    )


def pending(bundles: DataFrame, ledger: DataFrame, bundle: str = "bundle_id", n_bytes: str | None = None,
            upload_empty: bool = True) -> DataFrame:
    """Bundles still to be sent, including those left from an earlier run; empty ones only when allowed."""
    closed = ledger.filter(F.col("outcome") != RETRY).select(bundle).distinct()
    todo = bundles.join(closed, bundle, "left_anti")
    return todo if upload_empty or n_bytes is None else todo.filter(F.col(n_bytes) > 0)


def deliver(bundles: DataFrame, post_fn: PostFn, headers: dict[str, str] | None = None, compress: bool = False,
            bundle: str = "bundle_id", payload: str = "payload") -> DataFrame:
    """Send every payload through ``post_fn(body, headers) -> (status, error)`` on the executors; gives ledger rows.

    A task that is run again sends its bundles again, so the endpoint sees every bundle at least once.
    """
    sent_headers = {"Content-Type": "application/json", **(headers or {})}
    if compress:
        sent_headers["Content-Encoding"] = "gzip"

    schema = T.StructType.fromDDL("bundle_id string, attempt_ts timestamp, status int, error_text string")
    target = arrow_schema(schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0), batch.column(1)):  # one payload at a time becomes an object
                text = text.as_py()
                body = text.encode() if isinstance(text, str) else bytes(text)
                try:
                    status, error = post_fn(gzip.compress(body) if compress else body, sent_headers)
                except Exception as e:  # a failed call is an outcome like any other
                    status, error = 500, str(e)
                rows.append((str(key.as_py()), datetime.now(UTC), status, error))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    attempts = bundles.select(bundle, payload).mapInArrow(send, schema)
    return attempts.withColumn("outcome", outcome(F.col("status")))


def deliver_pending(spark: SparkSession, bundles: DataFrame, ledger_path: str, post_fn: PostFn, **options) -> DataFrame:
    """One round: send what the ledger at ``ledger_path`` does not list as closed, append the outcomes, return them."""
    keyed = bundles.withColumn("bundle_id", F.col("bundle_id").cast("string"))
    known = read_ledger(spark, ledger_path)
    sent = deliver(pending(keyed, known), post_fn, **options)
    sent.write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def deliver_batch(spark: SparkSession, bundles: DataFrame, ledger_path: str, post_fn: PostFn, number: int, **options) -> None:
    """One micro-batch: send its bundles and those that the batch before left to be tried again.

    The payloads to be tried again lie in ``<ledger_path>-retry/<number>``; a batch reads its predecessor's and writes its
    own, so each is read once and a batch that runs again finds what it found before.
    """
    queue = lambda n: f"{ledger_path}-retry/{n}"
    keyed = bundles.withColumn("bundle_id", F.col("bundle_id").cast("string"))
    left = read_if_there(spark, queue(number - 1), "bundle_id string, payload string")
    # a batch that runs again finds in the ledger what it already sent, of the queue as of its own bundles
    todo = pending(keyed.select("bundle_id", "payload").unionByName(left), read_ledger(spark, ledger_path))
    todo = todo.dropDuplicates(["bundle_id"])
    attempts = f"{ledger_path}-attempts/{number}"
    deliver(todo, post_fn, **options).write.mode("overwrite").parquet(attempts)
    outcomes = spark.read.schema(LEDGER).parquet(attempts)
    again = outcomes.filter(F.col("outcome") == RETRY).select("bundle_id")
    todo.join(again, "bundle_id", "left_semi").write.mode("overwrite").parquet(queue(number))
    outcomes.write.mode("append").parquet(ledger_path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows written so far; empty before the first round."""
    return read_if_there(spark, path, LEDGER)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet rows below the path; none if there is no such path. Any other fault is raised."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
