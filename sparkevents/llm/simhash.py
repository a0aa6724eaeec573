"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are grouped by the population counts of their four 16-bit quarters. Two fingerprints that differ
in at most ``radius`` bits have counts that differ by at most ``radius`` in sum, so only tiles of near counts meet. A
pair of tiles is compared in full with exclusive-or and bit counts; of its links, only a spanning forest is kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, fresh, materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints of a tile; larger groups of equal counts are cut into several tiles.
TILE = 4096
#: Pairs of two tiles up to which they are compared together with those of other rows.
SMALL = 2048
#: Shingles whose bits are added up at a time, so that a very long text needs no more memory than a long one.
BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64 bits, signed: a bit is 1 if it is set in over half of the shingles' hashes. No words: 0.

    Only A-Z are lower-cased and only ASCII white space separates words, as ``bytes`` methods do.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    stops = ends[width - 1 :] or ends[-1:]
    digest = xxhash.xxh64_digest
    counts, total = np.zeros(64, np.int64), len(stops)
    for at in range(0, total, BLOCK):
        part = zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=False)
        raw = b"".join([digest(joined[s : e - 1], SEED) for s, e in part])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", width: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a long."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(x, width) for x in texts], dtype="int64")

    return docs.withColumn(out, prints(F.col(text)))


def forest(size: int, u: np.ndarray, v: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest node of each node's component, after joining the ends of the edges ``(u, v)``."""
    parent = np.arange(size) if parent is None else parent
    while True:
        a, b = parent[u], parent[v]
        apart = a != b
        if not apart.any():
            return parent
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent != parent[parent]).any():
            parent = parent[parent]


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of differing bits; the sign is a bit like any other."""
    return np.bitwise_count((x ^ y).view(np.uint64))


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edges that connect what the links ``(u, v)`` connect: each fingerprint with the smallest of its component."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = forest(len(ids), at[: len(u)], at[len(u) :])
    hang = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[hang], ids[parent[hang]]


def linked(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links between two tiles."""
    u, v = [], []
    for at in range(0, len(left), 256):
        block = left[at : at + 256]
        i, j = np.nonzero(differing(block[:, None], right[None, :]) <= radius)
        apart = block[i] != right[j]
        if apart.any():
            hung, on = spanning(block[i[apart]], right[j[apart]])
            u.append(hung)
            v.append(on)
    return (np.concatenate(u), np.concatenate(v)) if u else (left[:0], left[:0])


def linked_rows(lefts: pa.ListArray, rights: pa.ListArray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links in each row's pair of tiles; small tiles of many rows are compared at once."""
    a, b = lefts.flatten().to_numpy(), rights.flatten().to_numpy()
    n, m = lefts.value_lengths().to_numpy(), rights.value_lengths().to_numpy()
    at, bt = np.cumsum(n) - n, np.cumsum(m) - m
    pairs = n.astype(np.int64) * m
    u, v = [a[:0]], [a[:0]]
    for row in np.flatnonzero(pairs > SMALL):
        hung, on = linked(a[at[row] : at[row] + n[row]], b[bt[row] : bt[row] + m[row]], radius)
        u.append(hung)
        v.append(on)
    small = np.flatnonzero((pairs > 0) & (pairs <= SMALL))
    for some in np.array_split(small, max(1, -(-int(pairs[small].sum()) // (1 << 21)))):
        of = np.repeat(some, pairs[some])
        place = np.arange(len(of)) - np.repeat(np.cumsum(pairs[some]) - pairs[some], pairs[some])
        x, y = a[at[of] + place // m[of]], b[bt[of] + place % m[of]]
        near = (differing(x, y) <= radius) & (x != y)
        u.append(x[near])
        v.append(y[near])
    return spanning(np.concatenate(u), np.concatenate(v))


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``fingerprint`` (distinct longs) to edges ``(u, v)`` that connect what pairs within ``radius`` bits connect."""
    f = F.col("fingerprint")
    quarters = [F.bit_count(F.shiftrightunsigned(f, 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    key = sum((q * 17**i for i, q in enumerate(quarters)), F.lit(0)).cast("int")
    keyed = prints.select(f, key.alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))  # 17^4 rows at most
    part = F.pmod(F.xxhash64(f), F.col("parts")).cast("int")
    tiles = (
        keyed.join(F.broadcast(sizes), "key")
        .groupBy("key", part.alias("part"))
        .agg(F.collect_list("fingerprint").alias("members"))
    )
    near = F.array(*[F.lit(sum(d * 17**i for i, d in enumerate(step))) for step in steps(radius)])
    digits = [F.floor(F.col("key") / 17**i) % 17 for i in range(4)]
    shifts = F.array(*[F.array(*map(F.lit, step)) for step in steps(radius)])
    inside = lambda step: F.forall(
        F.zip_with(F.array(*digits), step, lambda d, x: d + x), lambda y: (y >= 0) & (y <= 16)
    )
    pairs = F.filter(F.arrays_zip(near.alias("by"), shifts.alias("step")), lambda x: inside(x["step"]))
    sent = tiles.select("key", "part", "members", F.explode(pairs).alias("to"))
    sent = sent.select("key", "part", F.col("members").alias("left"), (F.col("key") + F.col("to.by")).alias("key_"))
    sent = sent.join(F.broadcast(sizes.select(F.col("key").alias("key_"), "parts")), "key_")
    sent = sent.withColumn("part_", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # of (a, b) and (b, a) one is enough
    sent = sent.filter((F.col("key") < F.col("key_")) | (F.col("part") <= F.col("part_")))
    other = tiles.select(F.col("key").alias("key_"), F.col("part").alias("part_"), F.col("members").alias("right"))
    met = sent.join(other, ["key_", "part_"]).select("left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = linked_rows(batch.column("left"), batch.column("right"), radius)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return met.mapInArrow(compare, "u long, v long").distinct()


def steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of the four counts that sum to ``radius`` at most, one of each pair of opposites."""
    span = range(-radius, radius + 1)
    near = [s for s in itertools.product(span, repeat=4) if sum(map(abs, s)) <= radius]
    return [s for s in near if sum(d * 17**i for i, d in enumerate(s)) >= 0]


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest id reachable over links of ``radius`` bits.

    Rows of one fingerprint are one node. Null and empty texts have fingerprint 0 and link like any other. A null id
    never names a component, unless no row of it has an id; repeated rows each keep their row.
    """
    return classes(with_fingerprint(docs.select(F.col(key).alias("doc_id"), text), text, width=width), radius).drop("root")


def classes(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint`` (and further columns) with the ``root`` (a fingerprint) and ``component_id`` of each row.

    Only the root names a component: ids may be null or stand for several texts.
    """
    marked = materialize(marked.drop("text"), "fingerprints")
    nodes = materialize(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("low")), "nodes")
    roots = components(links(nodes.select("fingerprint"), radius))
    rooted = nodes.join(roots.withColumnsRenamed({"u": "fingerprint", "v": "root"}), "fingerprint", "left")
    rooted = rooted.select("fingerprint", "low", F.coalesce("root", "fingerprint").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fingerprint", "root", "component_id")
    return marked.join(named, "fingerprint")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (of equal ids, of the text with the lowest hash)."""
    name, kept_id, kept_hash = (fresh(docs, c) for c in ("text_hash", "kept_id", "kept_hash"))
    hashed = F.xxhash64(F.col(text))
    marked = with_fingerprint(docs.select(F.col(key).alias("doc_id"), text, hashed.alias(name)), text, width=width)
    low = classes(marked, radius).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", name)).alias("m"))
    kept = low.select(F.col("m.doc_id").alias(kept_id), F.col(f"m.{name}").alias(kept_hash))
    rows = docs.withColumn(name, hashed)
    match = F.col(key).eqNullSafe(F.col(kept_id)) & (F.col(name) == F.col(kept_hash))
    return rows.join(kept, match, "left_semi").dropDuplicates([key, name]).drop(name)
