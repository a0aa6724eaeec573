"""The corpus pipeline: each stage works on what its predecessor kept, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkevents.llm import mixing, packing, secrets, simhash, toxicity
from sparkevents.llm.common import fresh, learnable, materialize, prepare, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    prepare(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learnable(3, 1))
    out = fresh(docs, "toxicity_score")
    return toxicity.score(docs, model, out=out).filter(f"{out} < {toxicity.THRESHOLD}").drop(out)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return simhash.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced; ``n_chars`` follows the text."""
    prepare(spark)
    model = secrets.train(secrets.labelled_samples(docs))
    return secrets.redacted(docs, model)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    prepare(spark)
    return mixing.emit(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their places in sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_filter),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Models and packing can't be expressed in SQL; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
