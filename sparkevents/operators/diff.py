"""Structural comparison of two outputs, line by line and JSON path by JSON path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V
from ..session import shared_dir

MISSING = "missing"
EXTRA = "extra"
TYPE = "type"
LENGTH = "length"
VALUE = "value"


def json_type(kind: Column) -> Column:
    """Type the comparison sees for a VARIANT kind: integers and fractions differ, all objects are alike."""
    return (
        F.when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string")
        .when(kind == "BIGINT", "int")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "VOID", "null")
        .when(kind.isin("DOUBLE", "FLOAT") | (kind.startswith("DECIMAL") & ~kind.endswith(",0)")), "float")
        .when(kind.startswith("DECIMAL"), "int")
        .otherwise("string")
    )


def _step(key: Column) -> Column:
    """Path step of an object key; characters that could be read as another step are escaped."""
    return F.concat(F.lit("."), F.regexp_replace(key, r"([.\[\\])", r"\\$1"))


def _children() -> Column:
    """Pairs below two objects or two arrays of one length: ``(path, g, n)``, a side that lacks a key being NULL."""
    as_object = lambda c: V.as_message(F.when(V.kind(F.col(c)).startswith("OBJECT"), F.col(c)))
    as_array = lambda c: F.when(V.kind(F.col(c)).startswith("ARRAY"), F.col(c)).try_cast("array<variant>")
    pair = lambda path, g, n: F.struct(path.alias("path"), g.alias("g"), n.alias("n"))
    g, n = as_object("g"), as_object("n")
    members = F.transform(
        F.array_distinct(F.concat(F.map_keys(g), F.map_keys(n))), lambda k: pair(F.concat("path", _step(k)), g[k], n[k])
    )
    items = F.transform(
        F.arrays_zip(as_array("g").alias("g"), as_array("n").alias("n")),
        lambda x, i: pair(F.concat("path", F.lit("["), i.cast("string"), F.lit("]")), x["g"], x["n"]),
    )
    return F.coalesce(members, items)


def _compared(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``pairs(keys, path, g, n)`` with what differs at the path itself, and the pairs below if nothing does."""
    kind = {c: V.kind(F.col(c)) for c in ("g", "n")}
    inner = {c: k.startswith("OBJECT") | k.startswith("ARRAY") for c, k in kind.items()}
    text = {c: F.when(~inner[c], F.col(c).cast("string")) for c in kind}
    size = {c: F.when(k.startswith("ARRAY"), F.size(F.col(c).try_cast("array<variant>"))) for c, k in kind.items()}
    problem = (
        F.when(F.col("n").isNull(), MISSING)
        .when(F.col("g").isNull(), EXTRA)
        .when(json_type(kind["g"]) != json_type(kind["n"]), TYPE)
        .when(~size["g"].eqNullSafe(size["n"]), LENGTH)
        .when(~text["g"].eqNullSafe(text["n"]), VALUE)
    )
    shown = lambda c: F.when(F.col("problem") == LENGTH, size[c].cast("string")).otherwise(text[c])
    rows = pairs.withColumn("problem", problem)
    return rows.select(
        *keys, "path", "problem", shown("g").alias("gold_value"), shown("n").alias("new_value"),
        F.when(F.col("problem").isNull(), _children()).alias("below"),
    )


def diff_lines(pairs: DataFrame, keys: list[str], gold: str = "gold", new: str = "new") -> DataFrame:
    """Differences between two JSON texts per line: ``(keys, path, problem, gold_value, new_value)``.

    Lines with equal text are dropped first. The rest is taken apart level by level: pairs of values at one path are
    rows, and pairs of objects or arrays that agree in themselves give rows for what is in them, until none is left. So
    only the outermost problem is reported, at any depth, and a job runs per level of the deepest document. Text that is
    no JSON counts as a string.
    """
    changed = pairs.filter(~F.col(gold).eqNullSafe(F.col(new)))
    one_sided = F.col(gold).isNull() | F.col(new).isNull()
    found = changed.filter(one_sided).select(
        *keys, F.lit("").alias("path"), F.when(F.col(new).isNull(), MISSING).otherwise(EXTRA).alias("problem"),
        F.col(gold).alias("gold_value"), F.col(new).alias("new_value"),
    )
    parsed = lambda c: F.coalesce(F.try_parse_json(c), F.col(c).cast("variant"))
    level = changed.filter(~one_sided).select(*keys, F.lit("").alias("path"), parsed(gold).alias("g"), parsed(new).alias("n"))
    spark = pairs.sparkSession
    while True:
        path = shared_dir(spark, "diff")
        compared = _compared(level, keys)
        compared.write.parquet(path)
        compared = spark.read.schema(compared.schema).parquet(path)
        found = found.unionByName(compared.filter("problem is not null").drop("below"))
        level = compared.filter("size(below) > 0").select(*keys, F.inline("below"))
        if level.isEmpty():
            return found


def diff_tables(gold: DataFrame, new: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Compare two outputs whose lines are identified by ``keys`` (such as file and line number)."""
    left = gold.select(*keys, F.col(value).alias("gold"))
    right = new.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias("new"))
    on = F.lit(True)
    for k in keys:
        on &= F.col(k) == F.col(f"_k_{k}")
    pairs = left.join(right, on, "full_outer").select(
        *[F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys], "gold", "new"
    )
    return diff_lines(pairs, keys)


def only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present on the left side only."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def only_in_gold(gold: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return only_in(gold, new, keys)


def only_in_new(gold: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return only_in(new, gold, keys)
