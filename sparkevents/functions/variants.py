"""Helpers over schema-less messages held as MAP<STRING, VARIANT>.

A missing key is SQL NULL; a JSON null is a VARIANT null, which is a present value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import numbers

MESSAGE = "map<string,variant>"


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def variant(c: Column) -> Column:
    return c.cast("variant")


def is_string(v: Column) -> Column:
    """Whether a value is a string, and not a number kept as text."""
    return (kind(v) == "STRING") & ~numbers.is_kept(v)


def is_object(v: Column) -> Column:
    return kind(v).startswith("OBJECT")


def marked_string(v: Column) -> Column:
    """Text of a string value as it is held (``numbers.unmarked_string`` reads it), NULL for every other kind."""
    return F.when(kind(v) == "STRING", v.cast("string"))


def string_value(v: Column) -> Column:
    """Text of a string value, NULL for every other kind."""
    return numbers.unmarked_string(marked_string(v))


def int32_value(v: Column) -> Column:
    """Value of an integer number that fits 32 bits, NULL for everything else."""
    return F.when(kind(v) == "BIGINT", F.try_variant_get(v, "$", "int"))


def as_message(v: Column) -> Column:
    """An object value as a message map, NULL for every other kind."""
    return v.try_cast(MESSAGE)


def as_object(m: Column) -> Column:
    """A message map (or an array of them) as one VARIANT; object keys come out in byte order."""
    return F.to_variant_object(m)


def value_map(values: dict[str, Column]) -> Column:
    """Map of the values that are not NULL. They are looked at twice: pass columns, not long expressions.

    No lambda is used, since Spark interprets a lambda with all that is computed inside of it.
    """
    none = F.create_map().cast(MESSAGE)
    return F.map_concat(*[F.when(v.isNotNull(), F.create_map(F.lit(k), v)).otherwise(none) for k, v in values.items()])


def without(m: Column, removed: tuple[str, ...]) -> Column:
    """The message without the ``removed`` keys."""
    return F.map_filter(m, lambda k, _: ~k.isin(*removed)) if removed else m


def put(m: Column, added: Column, removed: tuple[str, ...] = (), names: tuple[str, ...] | None = None) -> Column:
    """The message with ``removed`` keys dropped and all entries of the map ``added`` set, in one rebuild.

    ``added`` is looked at once per key: pass a column, not a long expression. ``names`` are all keys it may hold.
    """
    gone = (lambda k: k.isin(*removed)) if removed else (lambda k: F.lit(False))
    named = (lambda k: k.isin(*names)) if names else (lambda k: F.lit(True))
    return F.map_concat(F.map_filter(m, lambda k, _: ~gone(k) & ~(named(k) & F.map_contains_key(added, k))), added)


def assign(m: Column, key: str, value: Column) -> Column:
    """The message with one value, which is not NULL, set."""
    return F.map_concat(without(m, (key,)), F.create_map(F.lit(key), value))
