"""Bus messages from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("body", T.BinaryType()),
        T.StructField("routing_key", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)


def read_envelope(spark: SparkSession, path: str, fmt: str = "parquet", columns: dict[str, Column | str] | None = None,
                  streaming: bool = False, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """Bus messages from files in any Spark format, in batch or as a stream.

    Without ``columns`` the files hold the envelope itself and are read with its schema (JSON bodies are base64 text).
    ``columns`` maps envelope fields to expressions over files of another layout; fields it lacks are NULL, and
    further names in it are kept beside the envelope.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    declared = schema if schema is not None else (ENVELOPE if columns is None else None)
    df = (reader.schema(declared) if declared is not None else reader).load(path)
    if columns is None:
        return df
    expressions = {k: F.expr(c) if isinstance(c, str) else c for k, c in columns.items()}
    envelope = [
        (expressions[f.name].cast(f.dataType) if f.name in expressions else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in ENVELOPE
    ]
    extra = [c.alias(k) for k, c in expressions.items() if k not in ENVELOPE.names]
    return df.select(*extra, *envelope)


#: Tables with fewer splits than this are small files; dealing them out moves no more than these splits hold.
SPREAD = 32
#: Rows that one task takes of a table of messages: they cost up to a millisecond each, however small they are on disk.
SPREAD_ROWS = 100_000


def tasks_for(rows: int, cores: int) -> int:
    """Tasks over which that many rows are dealt out: one per core, more for more than ``SPREAD_ROWS`` rows each."""
    return max(cores, -(-rows // SPREAD_ROWS))


def spread(df: DataFrame, by_rows: bool = True) -> DataFrame:
    """Rows of a table of few splits over more tasks; tables of enough splits stay as they are.

    Message work is bound by the CPU, so a single small file would otherwise keep one core busy and the rest idle. Splits
    follow bytes, and a compact table has millions of rows in one; with ``by_rows`` the tasks grow with the rows instead.
    """
    cores = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD)
    wanted = tasks_for(df.count(), cores) if by_rows else cores
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def read_routing_dirs(spark: SparkSession, path: str, suffix: str = "json") -> DataFrame:
    """Corpus laid out as ``<path>/<routing key>/<n>.<suffix>``, one message per file.

    Partition-style directories (``routing_key=...``), as ``capture_raw`` writes them, are understood too.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix}")
        .load(path)
    )
    parent = F.element_at(F.split("path", "/"), -2)
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select(
        F.col("content").alias("body"),
        F.try_url_decode(F.regexp_replace(F.regexp_replace(parent, "^routing_key=", ""), r"\+", "%2B")).alias("routing_key"),
        F.lit(f"application/{suffix}").alias("content_type"),
        stem.alias("file"),
    )


def read_json_lines_export(spark: SparkSession, path_glob: str) -> DataFrame:
    """Exported newline-JSON files (or directories) for replay: raw line, parsed message, error for a bad line."""
    from ..operators.filters import parse_json_body

    lines = spark.read.text(path_glob).filter(F.length("value") > 0)
    return parse_json_body(lines.withColumn("body", F.col("value"))).drop("body")


def replay(df: DataFrame, n: int) -> DataFrame:
    """Every message ``n`` times, numbered by ``replay_no``; the copies are made where the row is."""
    return df.withColumn("replay_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
