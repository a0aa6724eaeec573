"""Mixing sources to target weights by systematic sampling.

A source's target decides how many copies each of its documents is expected to give. The documents of a source stand
by size, rising along the odd ranks and falling along the even ones; the prefix sums of the expected copies, shifted by
one random offset per source, cross an integer boundary as often as the document is emitted. As sizes change little from
one document to the next and the order begins and ends with small ones, the words taken stay close to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Rows of one source and size that are numbered in one task.
GROUP_ROWS = 500
#: Sizes that share a bin of the two-level prefix sums.
BIN = 256


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    blanks = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
    outer = F.left(text, F.lit(1)).isin(blanks).cast("int") + F.right(text, F.lit(1)).isin(blanks).cast("int")
    count = F.size(F.split(text, r"[\x20\x09-\x0D]+")) - outer
    return F.when(F.length(text) > 0, count).otherwise(0).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``.

    Sources in code point order (null last) weigh ``weights``, repeating. Targets share the sum of all sizes by weight;
    a target stops at ``most`` times its source's size and the excess goes to the others by weight until none is above.
    With the sources in order of size per weight, those that stop are the first ones: each candidate split has its own
    share per unit of weight, and the first source that stays under its cap with that share sets it.
    One row per source passes a task.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((order - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("per_weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    split = (
        sizes.withColumn("weight", weight)
        .withColumn("per_weight", cap / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        .withColumn("share", F.col("left") / F.sum("weight").over(after))
        .withColumn("free", F.col("share") <= F.col("per_weight"))
    )
    share = F.min(F.when(F.col("free"), F.struct("per_weight", "share"))).over(everything)["share"]
    target = F.least(cap, F.coalesce(share, F.lit(float("inf"))) * F.col("weight"))
    return split.withColumn("target", target).drop("weight", "per_weight", "left", "share", "free")


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 17,
) -> DataFrame:
    """All rows of ``docs`` with one more struct column ``mix(size, source_size, target, copies, taken)``.

    ``copies`` says how often the row is emitted, ``taken`` is ``copies * size``. Null sources form one source; null
    texts have size 0; a source without words has target 0 and no copies. Repeated rows each count; equal rows stand
    next to each other in the order, so it does not matter which of them is which. Reruns agree: the offset comes from
    the source's name and ``seed``. A column that is already called ``mix`` is replaced.

    Ranks come in three levels, so that neither a source nor a size must fit one task: bins of sizes within the source,
    sizes and hash groups within the bin (from counts), rows within the hash group.
    """
    names = docs.drop("mix").columns
    places = {c: f"c{i}_" for i, c in enumerate(names)}  # no name of the table meets one of a helper
    given = docs.select(*names).toDF(*places.values())
    mixed = _mixed(given, places[text], places[source], places[key], weights, most, seed)
    return mixed.toDF(*names, "mix")


def _mixed(docs: DataFrame, text: str, source: str, key: str, weights: tuple[int, ...], most: int, seed: int) -> DataFrame:
    s, z, g = fresh(docs, "source_key"), fresh(docs, "size_key"), fresh(docs, "group_key")
    named = F.when(F.col(source).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source)))  # null last, never null
    rows = docs.withColumns({s: named, z: word_count(F.col(text))})
    sizes = materialize(rows.select(s, z, F.col(key).alias("k_")), "sizes")
    hashed = lambda name: F.pmod(F.xxhash64(F.col(name), F.lit(seed)), F.lit(1 << 31))
    counted = sizes.groupBy(s, z).agg(F.count(F.lit(1)).alias("n"))
    groups = F.ceil(F.col("n") / GROUP_ROWS).cast("int")
    small = counted.select(
        F.col(s).alias("source"), F.col(z).alias("size"), "n", groups.alias("groups"), F.floor(F.col(z) / BIN).alias("bin")
    )
    totals = small.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("of"))
    plan = targets(totals, weights, most)

    # rows before each bin of a source, then before each (size, group) of a bin
    prior = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = small.groupBy("source", "bin").agg(F.sum("n").alias("n"))
    bins = bins.withColumn("before_bin", F.coalesce(F.sum("n").over(prior), F.lit(0))).drop("n")
    hot = small.filter("groups > 1").select(F.col("source").alias("s_"), F.col("size").alias("z_"), "groups")

    def grouped(df: DataFrame, name: str) -> DataFrame:
        match = (F.col(s) == F.col("s_")) & (F.col(z) == F.col("z_"))
        group = F.coalesce(F.pmod(hashed(name), F.col("groups")), F.lit(0)).cast("long")
        return df.join(hot, match, "left").withColumn(g, group).drop("s_", "z_", "groups")

    parts = grouped(sizes, "k_").groupBy(s, z, g).agg(F.count(F.lit(1)).alias("n"))
    parts = parts.withColumn("bin", F.floor(F.col(z) / BIN))
    inner = Window.partitionBy(s, "bin").orderBy(z, g).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before_part", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    starts = (
        parts.join(bins, (parts[s] == bins["source"]) & (parts["bin"] == bins["bin"]))
        .drop(bins["bin"], bins["source"])
        .join(plan, F.col(s) == plan["source"])
        .select(
            F.col(s).alias("s_"), F.col(z).alias("z_"), F.col(g).alias("g_"), "source_size", "target", "of",
            (F.col("before_bin") + F.col("before_part")).alias("before"),
        )
    )
    within = Window.partitionBy(s, z, g).orderBy(hashed(key), F.col(key))
    i = fresh(docs, "rank_key")
    ranked = grouped(rows, key).withColumn(i, F.row_number().over(within))
    match = (F.col(s) == F.col("s_")) & (F.col(z) == F.col("z_")) & (F.col(g) == F.col("g_"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    offset = F.pmod(F.xxhash64(F.col(s), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rank = F.col("before") + F.col(i)
    last = F.when(rank % 2 == 1, F.floor((rank + 1) / 2)).otherwise(F.col("of") + 1 - F.floor(rank / 2))
    copies = (F.floor(offset + rate * last) - F.floor(offset + rate * (last - 1))).cast("long")
    mixed = ranked.join(starts, match).withColumn("copies", copies)
    return mixed.select(
        *[mixed[c] for c in docs.columns],
        F.struct(
            F.col(z).alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col(z)).alias("taken")
        ).alias("mix"),
    )


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row as often as ``mix`` takes it, with the columns of ``docs``."""
    mixed = mix(docs, **options)
    copies = F.explode(F.expr("sequence(1, cast(mix.copies as int))"))
    number = fresh(mixed, "copy_")
    return mixed.filter("mix.copies > 0").select(*[c for c in mixed.columns if c != "mix"], copies.alias(number)).drop(number)
