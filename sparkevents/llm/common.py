"""Helpers of the corpus operators: hold-out rule, scratch tables, batches of texts, connected components."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, ship


#: Rows and bytes in an Arrow batch: texts are long, and a Python worker holds a few batches at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers and keep their batches small."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


@contextlib.contextmanager
def batches_of(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Arrow batches of about so many bytes for what runs inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, n_bytes)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves this remainder. A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus == remainder, F.lit(False))


def learnable(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """Rows that may be learned from: they have an id and are not held out."""
    return F.col(key).isNotNull() & ~held_out(modulus, remainder, key)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later plans start from files that outlive executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sampled(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows (all, if there are fewer), picked by a hash of ``keys``: the same rows on every run."""
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(*keys, F.lit(11)), F.lit(1 << 30)) < int(rows / total * (1 << 30)))


def runs(texts: list[str], chars: int, rows: int) -> Iterator[slice]:
    """Consecutive slices of at most ``rows`` texts and about ``chars`` characters (one text at least)."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > chars or i - start >= rows):
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)``, long ids: one row ``(u, v)`` per non-root node ``u`` with its root ``v``.

    The root is the smallest id of the component. Alternating large-star and small-star steps: each node links its
    larger (or smaller) neighbours to its smallest one, until every edge ends in a root. Every step is an aggregation
    and a join on node ids; the table between two rounds is written to the shared folder.
    """
    u, v = F.col("u"), F.col("v")
    now = materialize(
        edges.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges"
    )
    while True:
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter(v > u).join(lowest, "u").select(v.alias("u"), F.col("low").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        low = F.col("low")
        small = large.join(lowest, "u").filter(v != low).select(v.alias("u"), low.alias("v"))
        now = materialize(small.unionByName(lowest.select("u", low.alias("v"))).distinct(), "edges")
        if now.join(now.select(v.alias("u")).distinct(), "u", "left_semi").isEmpty():
            # every edge points at a root; a node with two roots would still have to be merged
            if now.groupBy("u").count().filter("count > 1").isEmpty():
                return now
