"""Merkle manifest of a dataset: a postorder log of hash trees, written by aligned builders, and proofs read from it.

The leaves of a group are numbered in order. A builder takes a block of ``FAN ** LEVELS`` consecutive leaves, whose
first number is a multiple of the block's size, and appends nodes to its log in the order in which they are complete:
a leaf, and whenever a run of ``FAN`` is full (or the leaves are over) the node above it. The roots of the blocks are the
leaves of the next tier, until one node is left. A node's place in a log follows from the sizes of the subtrees before it,
so proofs read the siblings of a leaf without any index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize

FAN = 8
#: Levels of a builder: 512 leaves, a log of at most 585 digests.
LEVELS = 3
DIGEST = 32
PATH = "array<struct<before:string,after:string>>"
PARTS = ["before", "after"]


def digest(*parts: Column | str) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, one after the other in UTF-8."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that neighbours can't run into each other."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def above(nodes: list[bytes]) -> bytes:
    """The digest of a run of nodes, whose inputs are the digests as hexadecimal text."""
    return hashlib.sha256("".join(map(bytes.hex, nodes)).encode()).digest()


def levels_of(count: int, most: int) -> int:
    """Levels above ``count`` leaves until one node is left, ``most`` at most."""
    levels = 0
    while count > 1 and levels < most:
        count, levels = -(-count // FAN), levels + 1
    return levels


def build(leaves: list[bytes], levels: int) -> list[bytes]:
    """The nodes of a tree of ``levels`` in the order of completion; the last one is the root."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels)]

    def append(node: bytes, level: int) -> None:
        log.append(node)
        if level < levels:
            waiting[level].append(node)
            if len(waiting[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        run, waiting[level] = waiting[level], []
        append(above(run), level + 1)

    for leaf in leaves:
        append(leaf, 0)
    for level in range(levels):
        if waiting[level]:
            close(level)
    return log


def position(count: int, levels: int, level: int, index: np.ndarray) -> np.ndarray:
    """Places in the log of nodes ``index`` of a level, in a tree over ``count`` leaves.

    Complete before a node are its own subtree and those before it: ``(index + 1) * FAN ** d`` nodes ``d`` levels below
    (fewer at the right border), ``index`` on its level and one for every ``FAN ** d`` of them ``d`` levels above.
    """
    place = index.astype(np.int64)
    for below in range(level):
        place = place + np.minimum((index + 1) * FAN ** (level - below), -(-count // FAN**below))
    for higher in range(level + 1, levels + 1):
        place = place + index // FAN ** (higher - level)
    return place


@cache
def _places(count: int, levels: int) -> list[np.ndarray]:
    return [position(count, levels, h, np.arange(-(-count // FAN**h))) for h in range(levels + 1)]


def siblings(log: bytes, count: int, levels: int, upper: list[dict]) -> tuple[list[str], list[str]]:
    """For all leaves and levels, one leaf after the other: the run's nodes before and after, as text. ``upper`` is the
    path of the log's root and ends every leaf's."""
    text, size = log.hex(), 2 * DIGEST
    before: list[list[str]] = []
    after: list[list[str]] = []
    for level, places in enumerate(_places(count, levels)[:levels]):
        nodes = [text[size * p : size * (p + 1)] for p in places.tolist()]
        runs = ["".join(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        at = np.arange(count) // FAN**level
        pairs = list(zip((at // FAN).tolist(), (at % FAN * size).tolist(), strict=True))
        before.append([runs[r][:a] for r, a in pairs])
        after.append([runs[r][a + size :] for r, a in pairs])
    for step in upper:
        before.append([step["before"]] * count)
        after.append([step["after"]] * count)
    flat = [[x for leaf in zip(*side, strict=True) for x in leaf] for side in (before, after)]
    return flat[0], flat[1]


@dataclass(frozen=True)
class Manifest:
    """A tree over groups of rows. ``tiers[0]`` holds a row per block of leaves: ``group, block, count, levels, log`` and
    what the leaves carry; the following ones lead to ``group, root``; ``top`` is the manifest over the groups' roots."""

    tiers: list[DataFrame]
    roots: DataFrame
    top: Manifest | None = None


def numbered(rows: DataFrame, group: str, order: list[str], name: str, shared: str) -> DataFrame:
    """Number the rows of each group from 0 in ``order`` (``name``) and add their count (``shared``).

    One sort by range over all groups; a group's numbers begin with the count of its rows in the partitions before.
    """
    place, first = fresh(rows, "place"), fresh(rows, "first")
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = materialize(dealt.withColumn(place, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(place, 33)
    own = Window.partitionBy(group)
    parts = (
        dealt.groupBy(group, part.alias("part")).agg(F.count("*").alias("rows"), F.min(place).alias(first))
        .withColumn(name, F.sum("rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
        .select(F.col(group).alias("of"), "part", first, F.coalesce(name, F.lit(0)).alias("begins"), F.sum("rows").over(own).alias(shared))
    )
    return (
        dealt.join(parts, F.col(group).eqNullSafe(F.col("of")) & (part == F.col("part")))
        .withColumn(name, F.col(place) - F.col(first) + F.col("begins"))
        .drop("of", "part", "begins", first, place)
    )


def blocks(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The logs of one tier over ``group, index, count, digest`` and ``carried``, a row per block."""
    size = FAN**levels

    def logged(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("index")
        height = levels_of(rows["count"][0].as_py(), levels)
        log = build(rows["digest"].to_pylist(), height)
        carried = rows["carried"].combine_chunks()
        return pa.table(
            {
                "group": rows["group"][:1], "block": [rows["index"][0].as_py() // size],
                "blocks": [-(-rows["count"][0].as_py() // size)], "count": [len(rows)], "levels": [height],
                "root": [log[-1]], "log": [b"".join(log)],
                "carried": pa.ListArray.from_arrays(pa.array([0, len(carried)], pa.int32()), carried),
            }
        )

    kind = leaves.schema["carried"].dataType.simpleString()
    schema = (
        f"`group` string, block long, blocks long, count long, levels long, root binary, log binary, carried array<{kind}>"
    )
    block = F.floor(F.col("index") / size).alias("block")
    return materialize(leaves.groupBy("group", block).applyInArrow(logged, schema), "log")


def grown(leaves: DataFrame) -> Manifest:
    """All tiers over numbered leaves ``group, index, count, digest, carried``."""
    tiers = [blocks(leaves)]
    while not tiers[-1].filter("blocks > 1").isEmpty():
        index, count, root = F.col("block").alias("index"), F.col("blocks").alias("count"), F.col("root").alias("digest")
        tiers.append(blocks(tiers[-1].select("group", index, count, root, F.lit(0).alias("carried"))))
    return Manifest(tiers, tiers[-1].select("group", "root"))


def manifest(leaves: DataFrame, group: str, order: list[str], leaf: str, carry: list[str]) -> Manifest:
    """The manifest of a table of leaf digests (hexadecimal text).

    Leaves of a group (a string, null is a group of its own) are in the order of ``order`` and then of their digests, nulls
    first; leaves that are equal in all of this are interchangeable. The groups are in the order of their names, null
    first. ``carry`` names columns that the proofs show. An empty table has no groups and no root.
    """
    rows = leaves.select(
        F.col(group).alias("group"), *[F.col(c).alias(f"by{i}") for i, c in enumerate(order)],
        F.unhex(F.col(leaf)).alias("digest"), F.struct(*carry).alias("carried"),
        F.monotonically_increasing_id().alias("spread"),
    )
    rows = materialize(rows, "leaves")  # the last key spreads equal rows over the partitions
    keys = [*[f"by{i}" for i in range(len(order))], "digest", "spread"]
    own = grown(numbered(rows, "group", keys, "index", "count").select("group", "index", "count", "digest", "carried"))
    whole = F.lit(None).cast("string").alias("whole")
    names = numbered(own.roots.select(whole, F.col("group").alias("name"), "root"), "whole", ["name"], "index", "count")
    top = grown(
        names.select(F.col("whole").alias("group"), "index", "count", F.col("root").alias("digest"), F.struct("name").alias("carried"))
    )
    return Manifest(own.tiers, own.roots, top)


def opened(tier: DataFrame, ways: DataFrame) -> DataFrame:
    """The leaves of a tier, ``group, index, leaf, path, carried, known``, from the paths of its blocks,
    ``of, at, path, known``."""
    size = FAN**LEVELS
    rows = tier.join(ways, F.col("group").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    rows = rows.select("group", "block", "count", "levels", "log", "carried", "path", "known")
    carried, known = rows.schema["carried"].dataType.elementType.simpleString(), rows.schema["known"].dataType.simpleString()
    schema = f"`group` string, index long, leaf string, path {PATH}, carried {carried}, known {known}"

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["block", "count", "levels", "log", "path"]).to_pylist()):
                count, levels, log = row["count"], row["levels"], row["log"]
                before, after = siblings(log, count, levels, row["path"])
                steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], PARTS)
                ends = np.arange(count + 1, dtype=np.int32) * (levels + len(row["path"]))
                again = pa.array(np.full(count, i))
                places = (_places(count, levels)[0] * DIGEST).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("group").take(again), pa.array(row["block"] * size + np.arange(count)),
                        pa.array([log[p : p + DIGEST].hex() for p in places], pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), steps),
                        batch.column("carried").slice(i, 1).flatten(), batch.column("known").take(again),
                    ],
                    ["group", "index", "leaf", "path", "carried", "known"],
                )

    return rows.mapInArrow(leaves, schema)


def proofs(found: Manifest) -> DataFrame:
    """A row per leaf: ``group, index, leaf, subroot, root, path, carried``. ``path`` has an entry for every level from the
    leaf to the root: the digests of the run's nodes ``before`` and ``after``, joined. Digests are hexadecimal text."""
    last = found.top.tiers[-1]
    root = F.struct(F.lower(F.hex("root")).alias("root")).alias("known")
    ways = last.select(F.col("group").alias("of"), F.col("block").alias("at"), F.array().cast(PATH).alias("path"), root)
    for tier in reversed(found.top.tiers):
        leaves = opened(tier, ways)
        ways = leaves.select(F.col("group").alias("of"), F.col("index").alias("at"), "path", "known")
    known = F.struct("known.root", F.col("leaf").alias("subroot")).alias("known")
    ways = leaves.select(F.col("carried.name").alias("of"), F.lit(0).cast("long").alias("at"), "path", known)
    for tier in reversed(found.tiers):
        leaves = opened(tier, ways)
        ways = leaves.select(F.col("group").alias("of"), F.col("index").alias("at"), "path", "known")
    return leaves.select("group", "index", "leaf", "known.subroot", "known.root", "path", "carried")


def proof_digest(path: Column | str) -> Column:
    """The digest of all siblings, level by level."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def folded(path: Column | str, leaf: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))
