"""Schemas: fitting nested columns to a declared one, and the Arrow form tasks exchange."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def fit(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` cast to ``want`` by field name: fields the input lacks become NULL, a NULL struct stays NULL."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        there = {f.name: f.dataType for f in have}
        inner = F.struct(
            *[
                (fit(c[f.name], there[f.name], f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in want
            ]
        )
        return F.when(c.isNotNull(), inner)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: fit(x, have.elementType, want.elementType))
    return c.cast(want)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)
