"""Quality: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of a text are standardised and mapped to random cosines, whose inner products approximate a Gaussian kernel.
Ridge scores come from normal equations that are summed by partition; an isotonic fit on other labelled rows turns
scores into shares of good documents.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

COSINES = 256
RIDGE = 1e-3
SEED = 13
THRESHOLD = 0.3
#: Partitions whose normal equations are sent to the driver, whatever the number of rows.
PARTIAL_SUMS = 32
BINS = 400
#: Raw scores outside this range share the outer bins.
RANGE = (-0.5, 1.5)

STATISTICS = (
    "log_chars", "log_words", "log_lines", "word_length", "word_length_spread", "letters", "upper", "digits", "blanks", "marks",
    "rare_marks", "wide", "capital_words", "marked_words", "bare_marks", "repeated_next", "distinct_words", "top_word",
    "distinct_lines", "stopless_ends",
)
_CLASSES = np.zeros((6, 256))
_CLASSES[0, [*range(65, 91), *range(97, 123)]] = 1
_CLASSES[1, 65:91] = 1
_CLASSES[2, 48:58] = 1
_CLASSES[3, [32, *range(9, 14)]] = 1
_CLASSES[4, [c for c in range(33, 127) if not chr(c).isalnum()]] = 1
_CLASSES[5, [ord(c) for c in "#$%&*@^~|<>{}[]\\=_+!"]] = 1


def statistics(text: str) -> list[float]:
    """One number per entry of ``STATISTICS`` for a whole text; all 0 for an empty one."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return [0.0] * len(STATISTICS)
    share = _CLASSES @ np.bincount(raw, minlength=256) / len(raw)
    wide = float((raw >= 128).mean())
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), float(np.minimum(sizes, 50).mean()), float(np.minimum(sizes, 50).std()),
        *share[:5], share[5], wide,
        sum(map(str.isupper, words)) / n,
        sum(w[-1] in "#$%&*!@^~|" for w in words) / n,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        len(set(lines)) / len(lines),
        sum(not x[-1:].isalnum() for x in lines) / len(lines),
    ]


def with_statistics(docs: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """``docs`` with the statistics of each whole text; a null text counts as empty."""

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.array(statistics(t or ""), float) for t in texts], dtype=object)

    return docs.withColumn(out, measured(F.col(text)))


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    turns: np.ndarray  # frequencies of the cosines
    phase: np.ndarray
    weight: np.ndarray
    knots: np.ndarray  # raw scores
    levels: np.ndarray  # and the calibrated score at each

    def cosines(self, values: np.ndarray) -> np.ndarray:
        standard = np.clip((values - self.mean) / self.scale, -6, 6)
        waves = np.cos(standard @ self.turns + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([waves, np.ones((len(values), 1))])

    def raw(self, values: np.ndarray) -> np.ndarray:
        return self.cosines(values) @ self.weight

    def score(self, values: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(values), self.knots, self.levels), 0, 1)


def train(
    measured: DataFrame,
    labels: DataFrame,
    learn: Column,
    calibrate: Column,
    key: str = "doc_id",
    label: str = "quality",
    cosines: int = COSINES,
    ridge: float = RIDGE,
    seed: int = SEED,
) -> QualityModel:
    """Fit on the labelled rows of ``measured(key, statistics)`` for whose ids ``learn`` holds; of them, those for whose
    ids ``calibrate`` holds set the calibration.

    Labels other than 0 and 1 are left out, as are labels without a document. Without labels every score is 0.5.
    """
    known = labels.filter(learn & F.col(label).isin(0, 1)).select(key, F.col(label).cast("double").alias("y"))
    rows = materialize(measured.join(known, key).select("statistics", "y", calibrate.alias("calibrates")), "quality")
    width = len(STATISTICS)
    value = [F.col("statistics")[i] for i in range(width)]
    sums = rows.agg(F.count("y").alias("n"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(value)],
                    *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(value)]).first()
    draw = np.random.default_rng(seed)
    turns, phase = draw.normal(size=(width, cosines)) / np.sqrt(width), draw.uniform(0, 2 * np.pi, cosines)
    if not sums["n"]:
        flat = np.zeros(cosines + 1)
        return QualityModel(np.zeros(width), np.ones(width), turns, phase, flat, np.array([0.0]), np.array([0.5]))
    mean = np.array([sums[f"m{i}"] for i in range(width)])
    scale = np.maximum([sums[f"s{i}"] for i in range(width)], 1e-3)
    model = QualityModel(mean, scale, turns, phase, np.zeros(cosines + 1), np.array([0.0]), np.array([0.5]))

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, side = np.zeros((cosines + 1, cosines + 1)), np.zeros(cosines + 1)
        for batch in batches:
            z = model.cosines(np.stack(batch["statistics"]))
            gram += z.T @ z
            side += z.T @ batch["y"].to_numpy()
        yield pd.DataFrame({"gram": [gram.ravel()], "side": [side]})

    fitted = rows.filter("not calibrates").coalesce(PARTIAL_SUMS)
    gram, side = np.zeros((cosines + 1, cosines + 1)), np.zeros(cosines + 1)
    for part in fitted.mapInPandas(equations, "gram array<double>, side array<double>").collect():
        gram += np.reshape(part["gram"], gram.shape)
        side += part["side"]
    weight = np.linalg.solve(gram + ridge * max(1.0, gram[-1, -1]) * np.eye(len(side)), side)
    model = QualityModel(mean, scale, turns, phase, weight, np.array([0.0]), np.array([0.5]))

    low, high = RANGE
    at = F.floor((raw_score(model)(F.col("statistics")) - low) / (high - low) * BINS)
    bins = rows.filter("calibrates").groupBy(F.greatest(F.lit(0), F.least(F.lit(BINS - 1), at)).alias("at"))
    counts = bins.agg(F.count("y").alias("n"), F.sum("y").alias("good")).orderBy("at").collect()
    if not counts:
        return QualityModel(mean, scale, turns, phase, weight, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    middle = [low + (r["at"] + 0.5) * (high - low) / BINS for r in counts]
    levels = isotonic(np.array([r["good"] for r in counts]), np.array([float(r["n"]) for r in counts]))
    return QualityModel(mean, scale, turns, phase, weight, np.array(middle), levels)


def isotonic(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rising shares closest to ``good / n`` (weighted squares), by merging neighbours that fall.

    Each block gets half a good and half a bad document more, so that no share is quite 0 or 1.
    """
    blocks: list[list[float]] = []
    for g, k in zip(good, n, strict=True):
        blocks.append([g, k, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g_, k_, count = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g_, blocks[-1][1] + k_, blocks[-1][2] + count]
    levels = np.concatenate([np.full(int(c), (g + 0.5) / (k + 1)) for g, k, c in blocks])
    return np.maximum.accumulate(levels)


def raw_score(model: QualityModel):
    @F.pandas_udf("double")
    def raw(values: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(values)) if len(values) else [], dtype="float64")

    return raw


def score(measured: DataFrame, model: QualityModel, out: str = "score") -> DataFrame:
    """``measured`` with the calibrated score: higher, the likelier a document is good. Repeated rows get equal scores."""

    @F.pandas_udf("double")
    def calibrated(values: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(values)) if len(values) else [], dtype="float64")

    return measured.withColumn(out, calibrated(F.col("statistics")))


def scored(docs: DataFrame, labels: DataFrame, learn: Column, calibrate: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, score`` of every document; the statistics of the texts are measured once."""
    measured = materialize(with_statistics(docs.select(key, text), text).drop(text), "statistics")
    return score(measured, train(measured, labels, learn, calibrate, key)).select(key, "score")
