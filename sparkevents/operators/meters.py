"""Moving rates: exponentially decayed sums over 1, 5 and 15 minutes, read at the ends of five-second ticks.

A meter that is told every tick's rate ``r`` moves to ``m + a (r - m)`` with ``a = 1 - exp(-tick / minutes)``, and starts
at the rate of its first tick. Written out, an event in tick ``s`` weighs ``a exp(-tick / minutes) ^ (e - s)`` at the
end of tick ``e`` (without ``a`` if ``s`` is the first tick), so a meter is a sum that Spark combines before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import size_of

TICK_SECONDS = 5
MINUTES = (1, 5, 15)
#: Time constants after which a weight is below 1e-27, less than the precision of a sum over 10^11 events.
REACH = 64


def tick_of(ts: str | Column) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(TICK_SECONDS * 1_000_000)).cast("bigint")


def decayed(amount: Column, tick: Column, first: Column | int, last: Column | int, minutes: int) -> Column:
    """What ``amount`` adds, by its tick, to the rate a second at the end of ``last`` of a meter that runs from ``first``."""
    step = TICK_SECONDS / (60.0 * minutes)
    share = F.when(tick == first, 1.0).otherwise(-math.expm1(-step))
    return amount * share * F.exp((tick - last) * F.lit(step)) / F.lit(float(TICK_SECONDS))


def amounts(body: str) -> dict[str, Column]:
    return {"events": F.lit(1).cast("bigint"), "bytes": F.coalesce(size_of(body), F.lit(0).cast("bigint"))}


def meters(df: DataFrame, ts: str = "ingest_ts", body: str = "body", by: list[str] | None = None,
           span: tuple[int, int] | None = None) -> DataFrame:
    """Counts, mean rates and moving rates of events and bytes per key, all read at one time.

    ``span`` is the first and the last tick; without it, those of the earliest and the latest event, which are two numbers
    that the driver asks for. All meters start together, so a key that comes late counts as silent before. Events outside
    of the span and those without a time are not counted.
    """
    rows = df.withColumn("_tick", tick_of(ts))
    if span is None:
        ends = rows.agg(F.min("_tick").alias("a"), F.max("_tick").alias("b")).first()
        span = (ends["a"] or 0, ends["b"] or 0)
    first, last = span
    seconds = float((last - first + 1) * TICK_SECONDS)
    found = []
    for name, amount in amounts(body).items():
        total = F.coalesce(F.sum(amount), F.lit(0).cast("bigint"))
        found += [total.alias(f"n_{name}"), (total / F.lit(seconds)).alias(f"{name}_per_s")]
        moving = {m: F.sum(decayed(amount, F.col("_tick"), first, last, m)) for m in MINUTES}
        found += [F.coalesce(rate, F.lit(0.0)).alias(f"{name}_per_s_{m}m") for m, rate in moving.items()]
    return rows.filter(F.col("_tick").between(first, last)).groupBy(*(by or [])).agg(*found)


def meter_readings(df: DataFrame, every_seconds: int = 3600, ts: str = "ingest_ts", body: str = "body",
                   by: list[str] | None = None, first: int | None = None) -> DataFrame:
    """Moving rates of events and bytes per key at the end of every slot of time in which the key has events.

    Slots are whole ticks. Each slot gives its decayed sums, which are one row a key and slot; a reading adds those of the
    slots before, down to a weight that a double can't show. ``first`` is the meters' first tick, by default the earliest
    event's.
    """
    per_slot, odd = divmod(every_seconds, TICK_SECONDS)
    if odd or per_slot < 1:
        raise ValueError(f"a slot is a multiple of {TICK_SECONDS} seconds")
    keys = list(by or [])
    rows = df.withColumn("_tick", tick_of(ts)).filter("_tick is not null")
    if first is None:
        first = rows.agg(F.min("_tick")).first()[0] or 0
    slot = F.floor(F.col("_tick") / F.lit(per_slot)).cast("bigint")
    close = (F.col("_slot") + 1) * per_slot - 1
    names = [f"{name}_per_s_{m}m" for name in amounts(body) for m in MINUTES]
    parts = [decayed(amount, F.col("_tick"), first, close, m).alias(f"{name}_per_s_{m}m") for name, amount in amounts(body).items() for m in MINUTES]
    weighed = rows.filter(F.col("_tick") >= first).withColumn("_slot", slot).select(*keys, "_slot", *parts)
    sums = weighed.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("n_events"), *[F.sum(n).alias(n) for n in names])
    back = math.ceil(REACH * 60 * max(MINUTES) / every_seconds)
    before = Window.partitionBy(*keys).orderBy("_slot").rangeBetween(-back, 0)
    known = sums.withColumn("_known", F.collect_list(F.struct("_slot", *names)).over(before))

    def reading(name: str, minutes: int) -> Column:
        step = every_seconds / (60.0 * minutes)
        add = lambda s, k: s + k[name] * F.exp((k["_slot"] - F.col("_slot")) * F.lit(step))
        return F.aggregate("_known", F.lit(0.0), add).alias(name)

    readings = [reading(f"{name}_per_s_{m}m", m) for name in amounts(body) for m in MINUTES]
    at = F.timestamp_seconds((F.col("_slot") + 1) * every_seconds).alias("read_at")
    return known.select(*keys, at, "n_events", *readings)
