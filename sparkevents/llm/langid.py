"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds (multiplies) its letters' vectors, each permuted
by its distance from the n-gram's end; a text's vector bundles (adds) those of its n-grams; a language's prototype
bundles the unit vectors of its texts. A text takes the language of the prototype with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import runs

DIMENSIONS = 1024
ORDER = 3
SEED = 7
UNKNOWN = "und"
#: Texts of a language that are learned from (picked by a hash of the id, if there are more).
TRAIN_ROWS = 3_000
#: Texts and characters whose n-grams are bundled at a time.
ROWS, CHARS = 256, 1 << 20
BLOCK = 4096
#: Unit vectors are added up as whole numbers, so that the order of tasks does not matter.
UNIT = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prototypes: np.ndarray  # a unit vector per language


class Letters:
    """Numbers of letters in order of appearance (0: anything else) and their vectors, which depend on the letter only."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.number = np.full(0x110000, -1, np.int32)
        self.vectors = self.vector(0x20)[None]

    def vector(self, code: int) -> np.ndarray:
        draw = np.random.Generator(np.random.Philox(key=np.array([code, self.seed], np.uint64)))
        return (draw.integers(0, 2, self.dimensions) * 2 - 1).astype(np.int8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        found = self.number[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                letter = chr(code).isalpha()
                self.number[code] = len(self.vectors) if letter else 0
                if letter:
                    self.vectors = np.vstack([self.vectors, self.vector(code)])
            found = self.number[codes]
        return found


def bundles(texts: list[str], letters: Letters) -> np.ndarray:
    """A vector per text. White space, digits and marks are one boundary; texts without a letter give zeros."""
    out = np.zeros((len(texts), letters.dimensions), np.float32)
    for part in runs(texts, CHARS, ROWS):
        some = [f"\n{t.lower()}\n" for t in texts[part]]
        codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(some), dtype=np.int32), [len(t) for t in some])
        number = letters.of(codes)
        first = np.diff(doc, prepend=-1) > 0
        keep = (number > 0) | first | (np.concatenate(([0], number[:-1])) > 0)
        number, doc = number[keep].astype(np.int64), doc[keep]
        if len(number) < ORDER:
            continue
        size = len(letters.vectors)
        gram = (number[:-2] * size + number[1:-1]) * size + number[2:]
        whole = doc[:-2] == doc[2:]
        gram, doc = gram[whole], doc[:-2][whole]
        kinds, at = distinct(gram, size**3)
        for begin in range(0, len(kinds), BLOCK):
            block = kinds[begin : begin + BLOCK]
            inside = slice(None) if len(kinds) <= BLOCK else (at >= begin) & (at < begin + BLOCK)
            cell = doc[inside].astype(np.int64) * len(block) + (at[inside] - begin)
            counts = np.bincount(cell, minlength=len(some) * len(block)).reshape(len(some), len(block))
            out[part] += counts.astype(np.float32) @ grams(block, letters.vectors)
    return out


def distinct(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values below ``size`` and the place of each value among them."""
    if size > 1 << 23:
        return np.unique(values, return_inverse=True)
    kinds = np.flatnonzero(np.bincount(values, minlength=size))
    place = np.zeros(size, np.int64)
    place[kinds] = np.arange(len(kinds))
    return kinds, place[values]


def grams(codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Vectors of trigrams: letters permuted by 2, 1 and 0 places, multiplied."""
    size = len(vectors)
    a, b, c = codes // (size * size), codes // size % size, codes % size
    return (np.roll(vectors, 2, 1)[a] * np.roll(vectors, 1, 1)[b] * vectors[c]).astype(np.float32)


def train(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows: int = TRAIN_ROWS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> LanguageModel:
    """Prototypes from the texts with a language for whose ids ``learn`` holds, about ``rows`` a language at most.

    Texts without a letter say nothing; a language that has none else is not learned.
    """
    known = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(key).alias("key_"), F.col(lang).alias("lang_"), F.col(text).alias("text_"))
    sizes = docs.filter(learn & F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang_")).count()
    limit = F.least(F.lit(1.0), F.lit(float(rows)) / F.col("count")) * F.lit(float(1 << 30))
    # one row per language: the texts stay where they are
    picked = known.join(F.broadcast(sizes.select("lang_", limit.alias("limit_"))), "lang_")
    picked = picked.filter(F.pmod(F.xxhash64("key_", F.lit(seed)), F.lit(1 << 30)) < F.col("limit_"))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = Letters(dimensions, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            bundled = bundles(batch["text_"].tolist(), letters)
            length = np.linalg.norm(bundled, axis=1)
            unit = np.rint(bundled[length > 0] / length[length > 0, None] * UNIT).astype(np.int64)
            names = batch["lang_"].to_numpy()[length > 0]
            for name in pd.unique(names):
                sums[name] = sums.get(name, 0) + unit[names == name].sum(0)
        for name, vector in sums.items():
            yield pd.DataFrame({"lang": name, "at": np.arange(dimensions), "value": vector})

    parts = picked.select("lang_", "text_").mapInPandas(add, "lang string, at int, value long")
    cells = parts.groupBy("lang", "at").agg(F.sum("value").alias("value")).toPandas()  # dimensions x languages
    languages = sorted(cells["lang"].unique())
    sums = np.zeros((len(languages), dimensions))
    sums[cells["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), cells["at"].to_numpy(int)] = cells["value"]
    return LanguageModel(languages, sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-300))


def predict(
    docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language", seed: int = SEED
) -> DataFrame:
    """``docs`` with a struct ``out(lang_pred, score)``: the language and the cosine (0 if negative).

    Null texts and texts without a letter are ``und`` with score 0, like all texts if no language was learned. Of equal
    cosines the first language by code point wins. Repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x dimensions

    @F.pandas_udf("lang_pred string, score double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        letters = Letters(model.prototypes.shape[1], seed)
        for texts in batches:
            bundled = bundles([t or "" for t in texts], letters).astype(float)
            length = np.linalg.norm(bundled, axis=1)
            known = (length > 0) & (len(model.languages) > 0)
            name = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            if known.any():
                cosine = bundled[known] @ model.prototypes.T / length[known, None]
                best = cosine.argmax(1)
                name[known] = np.array(model.languages, object)[best]
                score[known] = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)
            yield pd.DataFrame({"lang_pred": name, "score": score})

    return docs.withColumn(out, nearest(F.col(text)))
