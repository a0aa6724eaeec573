"""Lookups against side tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_string(df: DataFrame, strings: DataFrame, guid: str = "filepath_string_guid", out: str = "path") -> DataFrame:
    """Text of each row's string id from a table ``(guid, utf8string, pos)``: lowest position wins, '' if none.

    The table is reduced to one row per id first; Spark sends it to all executors when its measured size allows, else
    both sides are shuffled on the id, and adaptive execution splits the rows of an id that is hot.
    """
    first = strings.groupBy("guid").agg(F.min_by("utf8string", "pos").alias("_text"))
    first = first.select(F.col("guid").alias("_guid"), "_text")
    joined = df.join(first, F.col(guid) == F.col("_guid"), "left")
    return joined.select(*df.columns, F.coalesce(F.col("_text").cast("string"), F.lit("")).alias(out))
