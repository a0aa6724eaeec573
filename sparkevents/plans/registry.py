"""Catalogue of queries: one per operator, each with the SQL that must give the same rows on the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import base64_text
from ..functions.variants import MESSAGE
from ..session import compiled_methods, require_utc, shared_dir, ship
from . import carriers


@dataclass(frozen=True)
class Tables:
    """The given tables and the carriers derived from them."""

    spark: SparkSession
    sf_dir: str

    def view(self, name: str) -> DataFrame:
        return carriers.view(self.spark, self.sf_dir, name)

    def messages_of(self, name: str = "bus_hits") -> DataFrame:
        """A JSON carrier with its body parsed into ``msg``."""
        return self.view(name).withColumn("msg", F.from_json("body", MESSAGE))

    def sensor_events(self) -> DataFrame:
        return carriers.sensor_events(self.spark, self.sf_dir)

    def scratch(self, purpose: str) -> str:
        return shared_dir(self.spark, purpose)


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, reads: tuple[str, ...] = (), ctes: str = "", recursive: bool = False):
    """Register a query. ``reads`` names the carriers its SQL uses; ``ctes`` are further ``name AS (...)`` parts."""

    def register(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql and with_ctes(sql, reads, ctes, recursive))
        return run

    return register


def with_ctes(sql: str, reads: tuple[str, ...], ctes: str = "", recursive: bool = False) -> str:
    parts = [p for p in (carriers.cte(*reads), ctes) if p]
    head = f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" if parts else ""
    return head + sql


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            require_utc(spark)
            compiled_methods(spark)
            ship(spark)
            return q.run(Tables(spark, sf_dir))

        return run

    return {name: bind(q) for name, q in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}


# ---- helpers for comparable results ----------------------------------------------------------------------------------


def text(key: str, m: str = "msg") -> Column:
    """A message value as text under its own name."""
    return F.col(m)[key].cast("string").alias(key)


def texts(*keys: str, m: str = "msg") -> list[Column]:
    return [text(k, m) for k in keys]


def plain(df: DataFrame) -> DataFrame:
    """Columns of types both engines share: numbers as BIGINT, binaries as base64 text, struct fields side by side."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.DecimalType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.BinaryType):
            out.append(base64_text(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            out += [F.col(f"{f.name}.{g.name}").alias(f"{f.name}_{g.name}") for g in f.dataType]
        else:
            out.append(F.col(f.name))
    return df.select(*out)
