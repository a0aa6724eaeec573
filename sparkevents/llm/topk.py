"""Exact top-k search by inner product over vectors in buckets of like length.

A query's k-th best score among the longest vectors is a lower bound ``low`` for its answer. Over a bucket whose longest
vector has length ``l``, only vectors with a cosine of at least ``low / (|query| * l)`` can reach it: if that exceeds 1
the bucket is skipped; if it is high, ranges of single coordinates select the candidates; else the vectors' lengths do.
The candidates' products are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K = 20
SCALE = 64
#: Ratio of the lengths at the ends of a bucket.
RATIO = 1.25
#: Vectors of a bucket that are compared in one task, and queries that meet them at a time.
TILE, QUERIES = 4096, 512
#: The longest vectors, which give the first lower bounds; they fit a broadcast of a fixed size.
SEEDS = 2048
#: Local cosine from which coordinates prune better than lengths.
COORDINATE = 0.6
FOCUS = 3
EXACT = float(1 << 53)

NOTHING = np.iinfo(np.int64).min


def whole_numbers(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long (saturated)."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def finite(embedding: Column) -> Column:
    """Whether the vector is there and all its components are finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.coalesce(embedding.isNotNull() & F.forall(embedding, fine), F.lit(False))


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of longs; shorter vectors are filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy()
    flat = vectors.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(float) ** 2).sum(1))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products (saturated at the ends of long)."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    if lengths(left).max() * lengths(right).max() < EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    wide = left.astype(object) @ right.T.astype(object)
    return np.clip(wide, np.iinfo(np.int64).min, np.iinfo(np.int64).max).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def lower_bounds(ids: np.ndarray, rows: np.ndarray, seed_ids: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query among the seeds other than itself; ``NOTHING`` if there are fewer."""
    scores = products(rows, seeds)
    scores[ids[:, None] == seed_ids[None, :]] = NOTHING
    if scores.shape[1] < k:
        return np.full(len(ids), NOTHING)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def candidates(query: np.ndarray, size: float, cosine: float, units: np.ndarray) -> np.ndarray:
    """Vectors whose largest-weight coordinates allow the cosine with the query."""
    focus = np.argsort(-np.abs(query))[:FOCUS]
    q = query[focus] / size
    slack = np.sqrt(np.maximum(0.0, (1 - cosine * cosine) * (1 - q * q))) + 1e-9
    low = np.where(q <= -cosine, -1.1, q * cosine - slack)
    high = np.where(q >= cosine, 1.1, q * cosine + slack)
    part = units[:, focus]
    return np.flatnonzero(((part >= low) & (part <= high)).all(1))


def search(
    ids: np.ndarray, rows: np.ndarray, low: np.ndarray, tile_ids: np.ndarray, tile: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each query, the k best vectors of the tile with a score of at least ``low``: query ids, vector ids, scores."""
    sizes, tile_sizes = lengths(rows), lengths(tile)
    order = np.argsort(-tile_sizes, kind="stable")
    tile_ids, tile, tile_sizes = tile_ids[order], tile[order], tile_sizes[order]
    longest = tile_sizes[0] if len(tile_sizes) else 0.0
    bound = np.where(low == NOTHING, -np.inf, low.astype(float))
    reach = sizes * longest
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach > 0, bound / reach, np.where(bound > 0, 2.0, -1.0))
    alive = np.flatnonzero(cosine <= 1 + 1e-9)
    if not len(alive) or not len(tile):
        return
    by_coordinate = alive[cosine[alive] >= COORDINATE]
    by_length = alive[cosine[alive] < COORDINATE]
    if len(by_coordinate):
        width = min(rows.shape[1], tile.shape[1])
        units = tile[:, :width] / np.maximum(tile_sizes, 1e-300)[:, None]
        for i in by_coordinate:
            some = candidates(rows[i, :width].astype(float), sizes[i], min(1.0, float(cosine[i])), units)
            scores = products(rows[i : i + 1], tile[some])[0]
            yield answer(ids[i], scores, tile_ids[some], low[i], k)
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(bound[by_length] > 0, bound[by_length] / sizes[by_length], 0.0).min()
        count = int(np.searchsorted(-tile_sizes, -(needed * (1 - 1e-9)), side="right"))
        scores = products(rows[by_length], tile[:count])
        for i, own in zip(by_length, scores, strict=True):
            yield answer(ids[i], own, tile_ids[:count], low[i], k)


def answer(query: int, scores: np.ndarray, ids: np.ndarray, low: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    some = np.flatnonzero((scores >= low) & (ids != query))
    some = some[best(scores[some], ids[some], k)]
    return np.full(len(some), query), ids[some], scores[some]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", embedding: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each query row by integer inner product.

    Rows without an id, null vectors and vectors with a null or infinite component take no part. Of several rows with
    one id the smallest vector counts. Vectors of unlike length are compared as if filled up with zeros. Fewer than k
    other rows give fewer ranks.
    """
    numbers = whole_numbers(F.col(embedding), scale)
    rows = vectors.filter(F.col(key).isNotNull() & finite(F.col(embedding)))
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), numbers.alias("v"), is_query.alias("asks"))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    bucket = F.when(F.col("size") > 0, F.floor(F.log("size") / float(np.log(RATIO)))).otherwise(-1).cast("int")
    rows = materialize(rows.withColumn("size", size).withColumn("bucket", bucket), "vectors")
    spark = rows.sparkSession

    # buckets are few: lengths of longs span some two hundred of them
    kinds = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("longest")).collect()
    buckets = [(r["bucket"], -(-r["n"] // TILE), r["longest"]) for r in kinds]
    parts = spark.createDataFrame([b[:2] for b in buckets], "bucket int, parts int")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    tiles = rows.join(F.broadcast(parts), "bucket").groupBy("bucket", part.alias("part"))
    tiles = tiles.agg(F.collect_list(F.struct("vec_id", "v")).alias("tile"))

    first = rows.orderBy(F.col("size").desc(), "vec_id").limit(SEEDS)
    longest = first.select("vec_id", "v").toArrow().combine_chunks()
    seed_ids = longest.column("vec_id").to_numpy()
    seeds = matrix(longest.column("v").combine_chunks()) if len(seed_ids) else np.zeros((0, 0), np.int64)
    shared = spark.sparkContext.broadcast((seed_ids, seeds))
    asked = rows.filter("asks")
    group = {r["bucket"]: -(-r["count"] // QUERIES) for r in asked.groupBy("bucket").count().collect()}
    groups = spark.createDataFrame(list(group.items()), "bucket int, parts int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("parts")).cast("int")
    blocks = asked.join(F.broadcast(groups), "bucket").groupBy("bucket", block.alias("block"))
    blocks = blocks.agg(F.collect_list(F.struct("vec_id", "v")).alias("queries")).select("queries")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed_ids, seeds = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                queries = batch.column(0)[i : i + 1].flatten()
                ids, own = queries.field(0).to_numpy(), matrix(queries.field(1))
                low = lower_bounds(ids, own, seed_ids, seeds, k)
                size = lengths(own)
                for number, count, top in buckets:
                    alive = np.flatnonzero((low == NOTHING) | (low <= size * top * (1 + 1e-9)))
                    if len(alive):
                        some = queries.take(pa.array(alive))
                        fields = [some.field(0), some.field(1), pa.array(low[alive])]
                        asked = pa.StructArray.from_arrays(fields, ["vec_id", "v", "low"])
                        block = pa.ListArray.from_arrays(pa.array([0, len(alive)], pa.int32()), asked)
                        columns = [pa.array([number], pa.int32()), pa.array([count], pa.int32()), block]
                        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "parts", "queries"])

    sent = blocks.mapInArrow(send, "bucket int, parts int, queries array<struct<vec_id:long,v:array<long>,low:long>>")
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries, tile = batch.column(0)[i : i + 1].flatten(), batch.column(1)[i : i + 1].flatten()
                ids, low = queries.field(0).to_numpy(), queries.field(2).to_numpy()
                found = list(search(ids, matrix(queries.field(1)), low, tile.field(0).to_numpy(), matrix(tile.field(1)), k))
                if found:
                    columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    met = sent.join(tiles, ["bucket", "part"]).select("queries", "tile")
    found = met.mapInArrow(compare, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
