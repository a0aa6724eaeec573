"""Tasks over which the rows of a table are dealt out."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sparkevents.plans import carriers
from sparkevents.plans.registry import Tables
from sparkevents.plans.stream_queries import drained, streamed


def write_events(folder, rows):
    """A table of few bytes and many rows in a single file."""
    pq.write_table(pa.table({"event_id": pa.array(range(rows), pa.int64())}), f"{folder}/events.parquet")


def most_rows_in_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_tasks_grow_with_the_rows_of_a_compact_table(spark, tmp_path):
    rows = 150_000 * min(spark.sparkContext.defaultParallelism, 32)
    write_events(tmp_path, rows)
    df = carriers.table(spark, str(tmp_path), "events")
    assert most_rows_in_a_task(df) <= 101_000
    assert df.count() == df.distinct().count() == rows


def test_small_tables_are_spread_over_the_cores_only(spark, tmp_path):
    write_events(tmp_path, 1_000)
    cores = min(spark.sparkContext.defaultParallelism, 32)
    assert carriers.table(spark, str(tmp_path), "events").rdd.getNumPartitions() == cores


def test_tasks_of_a_stream_grow_with_its_rows(spark, tmp_path):
    rows = 150_000 * spark.sparkContext.defaultParallelism
    write_events(tmp_path, rows)
    placed = streamed(Tables(spark, str(tmp_path)), "events").withColumn("task", F.spark_partition_id())
    written = drained(Tables(spark, str(tmp_path)), placed, "spread-test")
    assert written.groupBy("task").count().agg(F.max("count")).first()[0] <= 101_000
    assert written.select("event_id").distinct().count() == rows
