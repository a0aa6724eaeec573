"""Order-dependent work without putting a whole key into one task.

A key may hold a large share of all rows, so anything that depends on row order is done per (key, segment). Segments
are contiguous ranges of the order column with about ``rows_per_segment`` rows each; their boundaries are a short list
of quantiles that becomes a literal of the plan, so a retried task sees the same segments. What crosses segments is
one small summary row per (key, segment).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_SEGMENT = 2_000_000
MAX_SEGMENTS = 16_384

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def as_number(df: DataFrame, order: str) -> Column:
    """The order column as a number of the same order."""
    dtype = df.schema[order].dataType
    if isinstance(dtype, TIME_TYPES):
        return F.unix_micros(F.col(order).cast("timestamp"))
    if isinstance(dtype, T.NumericType):
        return F.col(order)
    raise TypeError(f"order column {order} must be a number or a time, not {dtype.simpleString()}")


def split_points(df: DataFrame, order: str, rows_per_segment: int = ROWS_PER_SEGMENT) -> list:
    """Ascending boundaries that cut the order column into about equal row counts; empty for small input.

    Reads only the order column, and brings back at most ``MAX_SEGMENTS`` numbers.
    """
    n = df.select(order).count()
    k = min(math.ceil(n / rows_per_segment), MAX_SEGMENTS)
    if k <= 1:
        return []
    probabilities = [i / k for i in range(1, k)]
    found = df.agg(
        F.percentile_approx(as_number(df, order), probabilities, max(10_000, 8 * k)).alias("q")
    ).first()["q"]
    return sorted(set(found))


def segment_of(value: Column, points: list) -> Column:
    """Number of boundaries at or below a value: a two-level search, about 2*sqrt(boundaries) comparisons."""
    if not points:
        return F.lit(0)
    width = math.isqrt(len(points) - 1) + 1
    blocks = [points[i : i + width] for i in range(0, len(points), width)]
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    literal = lambda xs: F.array(*[F.lit(x) for x in xs])
    if len(blocks) == 1:
        return below(literal(points))
    block = F.greatest(below(literal([b[0] for b in blocks])) - 1, F.lit(0))
    chosen = F.get(F.array(*[literal(b) for b in blocks]), block)
    return block * width + below(chosen)


def with_segment(df: DataFrame, order: str, rows_per_segment: int = ROWS_PER_SEGMENT, out: str = "_segment") -> tuple[DataFrame, bool]:
    """The rows with their segment number, and whether there is more than one segment."""
    points = split_points(df, order, rows_per_segment)
    return df.withColumn(out, segment_of(as_number(df, order), points)), bool(points)


def running(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column],
            rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """Add inclusive running sums per key in the order of a unique column."""
    rows, several = with_segment(df.select("*", *[c.alias(f"_{n}") for n, c in sums.items()]), order, rows_per_segment)
    inside = Window.partitionBy(*keys, "_segment").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = lambda n: F.sum(f"_{n}").over(inside)
    if not several:
        return rows.select(*df.columns, *[total(n).alias(n) for n in sums])
    part = rows.groupBy(*keys, "_segment").agg(*[F.sum(f"_{n}").alias(f"_part_{n}") for n in sums])
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_segment").alias("_k_segment"),
        *[F.coalesce(F.sum(f"_part_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
    )
    condition = F.col("_segment") == F.col("_k_segment")
    for k in keys:
        condition &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = rows.join(offsets, condition, "left")
    return joined.select(
        *df.columns, *[(total(n) + F.col(f"_before_{n}")).alias(n) for n in sums]
    )


def number_rows(df: DataFrame, keys: list[str], order: str, out: str = "n",
                rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """0-based running number per key."""
    counted = running(df, keys, order, {out: F.lit(1).cast("bigint")}, rows_per_segment)
    return counted.withColumn(out, F.col(out) - 1)
