"""Secret scans: fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Each model gives the probability of a token's characters, each given the two before it. A token whose log-likelihood
ratio (random over ordinary) per character and in sum is high enough is a span of the kind ``random``. Every token of 16
characters and more is scored; one of letters or of digits alone needs a higher ratio.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, sampled

KINDS = ("assign", "access", "hex", "random")
BASE = {
    "assign": re.compile(
        r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ),
    # all characters of a run count, so a minimum in the pattern finds the runs that pass afterwards
    "access": re.compile(r"AKIA[A-Z0-9]{16,}"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
ASSIGN_LENGTH = 6
LEAST = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
HAS_DIGIT, HAS_LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{5,}")
#: Characters of tokens; every other one counts as the first.
ALPHABET = "\0ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CLASS = np.zeros(128, np.int64)
CLASS[[ord(c) for c in ALPHABET]] = range(len(ALPHABET))
SAMPLE_ROWS = 4_000
PLACEHOLDER = "[secret]"


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratio of every (two characters, next character), flattened, and the limits of a span."""

    ratio: np.ndarray
    per_character: float = 0.35
    total: float = 8.0
    #: Limit a character for tokens without a digit or without a letter, which words and numbers are, too.
    per_character_plain: float = 2.0

    def is_random(self, token: str) -> bool:
        score = float(self.ratio[trigrams(token)].sum())
        mixed = HAS_DIGIT.search(token) and HAS_LETTER.search(token)
        return score >= self.total and score >= (self.per_character if mixed else self.per_character_plain) * len(token)


def trigrams(token: str) -> np.ndarray:
    codes = np.frombuffer(token.encode("latin-1", "replace"), np.uint8)
    codes = np.concatenate(([0, 0], CLASS[np.minimum(codes, 127)]))
    size = len(ALPHABET)
    return (codes[:-2] * size + codes[1:-1]) * size + codes[2:]


def transitions(counts: np.ndarray) -> np.ndarray:
    """Log probabilities: trigrams backed by bigrams, these by single characters, these by the uniform distribution."""
    size = len(ALPHABET)
    cube = counts.reshape(size, size, size).astype(float)
    pair, single = cube.sum(0), cube.sum((0, 1))
    p1 = (single + 1) / (single.sum() + size)
    p2 = (pair + 8 * p1) / (pair.sum(1, keepdims=True) + 8)
    p3 = (cube + 8 * p2[None]) / (cube.sum(2, keepdims=True) + 8)
    return np.log(p3).ravel()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Sorted ``(start, kind number, end)`` of the fixed patterns, in code points."""
    spans = [(m.start(), 0, m.end()) for m in BASE["assign"].finditer(text) if len(m.group(1)) >= ASSIGN_LENGTH]
    spans += [(m.start(), 1, m.end()) for m in BASE["access"].finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in BASE["hex"].finditer(text)]
    return sorted(spans)


def random_spans(text: str, base: list[tuple[int, int, int]], model: MarkovModel) -> list[tuple[int, int, int]]:
    """Tokens that look random, and what the sorted spans of the fixed patterns leave of a token, from 16 characters on."""
    found, at = [], 0
    for m in TOKEN.finditer(text):
        start = m.start()
        while at < len(base) and base[at][0] < m.end():
            if base[at][0] - start >= LEAST and model.is_random(text[start : base[at][0]]):
                found.append((start, 3, base[at][0]))
            start = max(start, base[at][2])
            if start >= m.end():  # the span may reach into the next token
                break
            at += 1
        if m.end() - start >= LEAST and model.is_random(text[start : m.end()]):
            found.append((start, 3, m.end()))
    return found


def seeded_strings(count: int = 3_000, seed: int = 5) -> list[str]:
    """Labelled random strings: the usual alphabets of keys, drawn from a seeded generator."""
    draw = random.Random(seed)
    alphabets = [ALPHABET[1:63], ALPHABET[1:27] + ALPHABET[53:63], "0123456789abcdef", ALPHABET[27:63], ALPHABET[1:]]
    return ["".join(draw.choices(alphabets[i % len(alphabets)], k=draw.randint(16, 48))) for i in range(count)]


def seeded_ordinary(count: int = 600, seed: int = 6) -> list[str]:
    """Labelled ordinary strings that a corpus may lack: decimal numbers, and words of syllables joined as in paths."""
    draw = random.Random(seed)
    numbers = ["".join(draw.choices("0123456789", k=draw.randint(5, 24))) for _ in range(count)]
    word = lambda: "".join(draw.choice("bcdfghlmnprstv") + draw.choice("aeiou") for _ in range(draw.randint(2, 4)))
    paths = [mark + mark.join(word() for _ in range(draw.randint(2, 5))) + mark for mark in draw.choices("/-_=+", [6, 3, 3, 1, 1], k=count)]
    return numbers + paths


def labelled_samples(docs: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``token, is_random, n``: strings inside the fixed patterns, and the words around them, of about ``rows`` texts."""
    schema = "token string, is_random boolean, n long"

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch.iloc[:, 0]:
                base = base_spans(value)
                inside = [value[s:e].split("=")[-1].split(":")[-1].strip(" \"'") for s, _, e in base]
                for start, _, end in reversed(base):
                    value = value[:start] + " " + value[end:]
                out += [(x, True) for x in inside]
                out += [(x, False) for x in WORD.findall(value)]
            frame = pd.DataFrame(out, columns=["token", "is_random"])
            yield frame.groupby(["token", "is_random"], as_index=False).size().rename(columns={"size": "n"})

    some = sampled(docs.filter(F.col(text).isNotNull()).select(text, key), rows, key).select(text)
    found = some.mapInPandas(tokens, schema)
    return found.groupBy("token", "is_random").agg(F.sum("n").alias("n"))


def train(samples: DataFrame, **limits: float) -> MarkovModel:
    """Both models from labelled tokens ``token, is_random``; distinct tokens count once.

    Transition counts are summed on the executors: a vector entry per (class, trigram), a bounded table. The seeded
    random and ordinary strings are among the samples, so that a corpus without secrets, numbers or paths gives a model, too.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for flag, tokens in batch.groupby("is_random")["token"]:
                cells, n = np.unique(np.concatenate([trigrams(t) for t in tokens]), return_counts=True)
                yield pd.DataFrame({"is_random": flag, "cell": cells, "n": n})

    spark = samples.sparkSession
    labelled = [(t, True) for t in seeded_strings()] + [(t, False) for t in seeded_ordinary()]
    seeded = spark.createDataFrame(labelled, "token string, is_random boolean")
    tokens = samples.select("token", "is_random").filter("token is not null and is_random is not null").unionByName(seeded)
    cells = tokens.distinct().mapInPandas(count, "is_random boolean, cell long, n long")
    counts = np.zeros((2, len(ALPHABET) ** 3))
    for row in cells.groupBy("is_random", "cell").agg(F.sum("n").alias("n")).collect():
        counts[int(row["is_random"]), row["cell"]] = row["n"]
    return MarkovModel(transitions(counts[1]) - transitions(counts[0]), **limits)


def scan(docs: DataFrame, model: MarkovModel, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with a column ``out``: an array of ``(kind, start, end)`` by start, then kind, in code points.

    Null and empty texts have no spans. Repeated rows are scanned each. A column already called ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: the alphabet cubed

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        markov = shared.value
        for texts in batches:
            found = []
            for value in texts:
                base = base_spans(value) if value else []
                spans = sorted(base + random_spans(value, base, markov)) if value else []
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pd.Series(found, dtype=object)

    return docs.withColumn(out, find(F.col(text)))


def redact(docs: DataFrame, model: MarkovModel, text: str = "text", mark: str = PLACEHOLDER) -> DataFrame:
    """``docs`` with every found span (overlapping ones as one) replaced by ``mark``; other texts stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        markov = shared.value
        for texts in batches:
            yield texts.map(lambda value: without_secrets(value, markov, mark) if value else value)

    return docs.withColumn(text, clean(F.col(text)))


def redacted(docs: DataFrame, model: MarkovModel, text: str = "text", size: str = "n_chars") -> DataFrame:
    """``redact``, with the column of text lengths brought up to date where a text changed."""
    if size not in docs.columns:
        return redact(docs, model, text)
    old = fresh(docs, "old_text")
    changed = redact(docs.withColumn(old, F.col(text)), model, text)
    length = F.when(F.col(old) == F.col(text), F.col(size)).otherwise(F.length(text)).cast(docs.schema[size].dataType)
    return changed.withColumn(size, F.when(F.col(text).isNull(), F.col(size)).otherwise(length)).drop(old)


def without_secrets(text: str, model: MarkovModel, mark: str = PLACEHOLDER) -> str:
    base = base_spans(text)
    parts, at = [], 0
    for start, _, end in sorted(base + random_spans(text, base, model)):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:] if parts else text


def digests(scanned: DataFrame, spans: str = "spans", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``: the span list as text, and counts of fixed patterns."""
    base = F.filter(F.col(spans), lambda s: s["kind"] != KINDS[3])
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counted = lambda kind: F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")
    counts = [counted(kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    return scanned.select(key, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col(spans)).alias("spans"))


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    """What ``base_sha256`` holds for these spans."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
