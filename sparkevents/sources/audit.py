"""Audit-log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Log file (without its extension) -> event type.
AUDIT_LABELS = {
    "live-response": "audit.log.liveresponse",
    "banning": "audit.log.banning",
    "isolation": "audit.log.isolation",
    "useractivity": "audit.log.useractivity",
}


def label_of(path: Column, labels: dict[str, str] | None = None) -> Column:
    """Event type of a log path, by the file's name or, for a directory of parts, by the directory's."""
    name = F.regexp_extract(path, r"([^/=]+?)(?:\.log)?(?:/part-[^/]*)?$", 1)
    label = None
    for stem, kind in (labels or AUDIT_LABELS).items():
        label = F.when(name == stem, kind) if label is None else label.when(name == stem, kind)
    return label


def tail_audit_logs(spark: SparkSession, paths: str | list[str], labels: dict[str, str] | None = None) -> DataFrame:
    """All lines of audit logs as ``(message, type)``; files without a label are left out."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    return lines.select(
        F.rtrim(F.col("value"), F.lit("\n")).alias("message"), label_of(F.col("_metadata.file_path"), labels).alias("type")
    ).filter(F.col("type").isNotNull())


def audit_events(lines: DataFrame, message: str = "message", log: str = "log", labels: dict[str, str] | None = None) -> DataFrame:
    """The same from lines already at hand, each with the name of its log."""
    return lines.withColumn("type", label_of(F.col(log), labels)).withColumnRenamed(message, "message").filter(
        F.col("type").isNotNull()
    )
