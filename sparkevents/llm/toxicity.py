"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram (hashed) in the text. Its scale is the log ratio of its share among toxic and
among clean documents; the n-grams whose counts depart most from independence are kept, and a logistic regression is
fitted on the scaled presences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, runs, sampled

BITS = 20
ORDERS = (3, 4, 5)
FEATURES = 2048
#: Labelled rows that are learned from (picked by a hash of the id, if there are more).
TRAIN_ROWS = 12_000
THRESHOLD = 0.7
LEAST_DOCS = 4
#: Characters whose n-grams are hashed at a time.
CHARS = 1 << 20
_MULTIPLIER = np.uint32(2654435761)


@dataclass(frozen=True)
class ToxicityModel:
    """Weight of each kept bucket (``place`` maps a bucket to it, -1: not kept) and the bias."""

    place: np.ndarray
    weight: np.ndarray
    bias: float


def buckets(codes: np.ndarray) -> list[np.ndarray]:
    """Hash bucket of the n-gram that starts at each character, one array per order."""
    found, h = [], codes
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * _MULTIPLIER + codes[n - 1 :]
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint32(15))) * _MULTIPLIER
            found.append(mixed >> np.uint32(32 - BITS))
    return found


def hits(texts: list[str], place: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """``(number of the text, distinct buckets in it)``; with ``place``, distinct places of the kept buckets.

    Texts are lower-cased and framed by blanks. Whole texts count: long ones are taken in overlapping stretches.
    """
    for part in runs(texts, CHARS, 4096):
        some = [f" {t.lower()} " for t in texts[part]]
        codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in some])
        begins = ends - [len(t) for t in some]
        if place is not None and len(some) > 1:
            pairs = []
            for grams, n in zip(buckets(codes), ORDERS, strict=True):
                at = np.flatnonzero(place[grams] >= 0)
                doc = np.searchsorted(ends, at, side="right")
                at, doc = at[at + n <= ends[doc]], doc[at + n <= ends[doc]]
                pairs.append(doc * len(place) + place[grams[at]])
            found = np.unique(np.concatenate(pairs))
            doc = found // len(place)
            for i, (a, b) in enumerate(zip(*np.searchsorted(doc, [range(len(some)), range(1, len(some) + 1)]), strict=True)):
                yield part.start + i, found[a:b] % len(place)
            continue
        for i, (a, b) in enumerate(zip(begins, ends, strict=True)):
            seen = np.zeros(1 << BITS, bool)
            for at in range(a, b, CHARS):
                for grams in buckets(codes[at : min(b, at + CHARS + max(ORDERS))]):
                    seen[grams] = True
            own = np.flatnonzero(seen)
            if place is not None:
                own = np.unique(place[own])
                own = own[own >= 0]
            yield part.start + i, own


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    rows: int = TRAIN_ROWS,
) -> ToxicityModel:
    """Fit on at most about ``rows`` labelled documents for whose ids ``learn`` holds.

    Labels other than 0 and 1 and documents without a text are left out; a label without a document, too. Without both
    classes the score is the share of toxic labels (0 without any).
    """
    known = labels.filter(learn & F.col(label).isin(0, 1)).select(F.col(key), F.col(label).cast("int").alias("label_"))
    some = sampled(known, rows, key)
    texts = docs.filter(F.col(text).isNotNull()).select(key, F.col(text).alias("text_"))
    # the sample is bounded by ``rows``, whatever the size of the corpus
    sample = materialize(texts.join(F.broadcast(some), key).select("label_", "text_"), "toxicity")
    sizes = {r["label_"]: r["count"] for r in sample.groupBy("label_").count().collect()}
    if len(sizes) < 2:
        rate = float(next(iter(sizes), 0))
        return ToxicityModel(np.full(1 << BITS, -1, np.int32), np.zeros(1), 8.0 * (2 * rate - 1))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for i, own in hits(batch["text_"].tolist()):
                seen[batch["label_"].iloc[i], own] += 1
        cells = np.flatnonzero(seen.any(0))
        yield pd.DataFrame({"bucket": cells, "clean": seen[0, cells], "toxic": seen[1, cells]})

    counts = sample.mapInPandas(count, "bucket int, clean int, toxic int")
    total = counts.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = sizes[1] / (sizes[0] + sizes[1])
    expected = (F.col("clean") + F.col("toxic")) * share
    departs = F.pow(F.col("toxic") - expected, F.lit(2.0)) / (expected + 1.0)
    kept = total.filter(F.col("clean") + F.col("toxic") >= LEAST_DOCS)
    kept = kept.orderBy(departs.desc(), "bucket").limit(FEATURES).toPandas()
    p, q = kept["toxic"].to_numpy() + 1.0, kept["clean"].to_numpy() + 1.0
    ratio = np.log(p / (sizes[1] + 2)) - np.log(q / (sizes[0] + 2))
    place = np.full(1 << BITS, -1, np.int32)
    place[kept["bucket"].to_numpy()] = np.arange(len(kept))

    def presences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [own.tolist() for _, own in hits(batch["text_"].tolist(), place)]
            yield pd.DataFrame({"label_": batch["label_"], "own": found})

    frame = sample.mapInPandas(presences, "label_ int, own array<int>").toPandas()
    weight, bias = fit(frame["label_"].to_numpy(float), frame["own"].tolist(), ratio)
    return ToxicityModel(place, weight * ratio, bias)


def fit(y: np.ndarray, own: list, ratio: np.ndarray, penalty: float = 1e-4, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled presences by Newton steps, each solved by conjugate gradients.

    Both classes weigh half of the loss, so that a rare one is not drowned. A few clean rows without any feature are added:
    a text that shows nothing is clean. The last weight is the bias.
    """
    empty = max(1, len(y) // 20)
    y, own = np.append(y, np.zeros(empty)), [*own, *[[]] * empty]
    sizes = np.array([len(x) for x in own])
    doc = np.repeat(np.arange(len(y)), sizes)
    at = np.concatenate([np.asarray(x, np.int64) for x in own])
    value = ratio[at]
    n, f = len(y), len(ratio)
    times = lambda w: np.bincount(doc, w[at] * value, minlength=n) + w[f]
    back = lambda g: np.append(np.bincount(at, g[doc] * value, minlength=f), g.sum())
    cost = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    ridge = np.append(np.full(f, penalty), 0.0)

    def loss(w: np.ndarray) -> float:
        z = times(w)
        return float((cost * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (ridge * w * w).sum())

    w = np.zeros(f + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(w), -40, 40)))
        gradient = back(cost * (p - y)) + ridge * w
        curve = cost * np.maximum(p * (1 - p), 1e-6)
        step, rest = np.zeros(f + 1), -gradient
        towards, size = rest, rest @ rest
        for _ in range(25):
            ahead = back(curve * times(towards)) + ridge * towards
            pace = size / max(towards @ ahead, 1e-300)
            step, rest = step + pace * towards, rest - pace * ahead
            before, size = size, rest @ rest
            if size <= 1e-6 * (gradient @ gradient):
                break
            towards = rest + size / before * towards
        now, length = loss(w), 1.0
        while length > 1e-3 and loss(w + length * step) > now:
            length /= 2
        w = w + length * step
    return w[:f], float(w[f])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that the whole text is toxic; null and empty texts have the score of no feature.

    Every row is scored by itself, repeated rows alike. A column already called ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: the table of buckets

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for texts in batches:
            values = [t or "" for t in texts]
            logit = np.full(len(values), model.bias)
            for i, own in hits(values, model.place):
                logit[i] += model.weight[own].sum()
            yield pd.Series(1 / (1 + np.exp(-np.clip(logit, -40, 40))))

    return docs.withColumn(out, probability(F.col(text)))
