"""Hashes of keys and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(field.dataType) for field in kind)
    return isinstance(kind, T.MapType)


def key_hash(keys: Sequence[str], seed: int | None = None) -> Column:
    """64 bits of a key.  Spark's hash passes over NULLs, so where these are is hashed as well."""
    parts = [x for k in keys for x in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())]
    return F.xxhash64(*([] if seed is None else [F.lit(seed)]), *parts)


def row_hash(df: DataFrame, columns: Sequence[str], seed: int | None = None) -> Column:
    """64 bits of some columns of a row; what holds maps is hashed as JSON text."""
    parts: list[Column] = [] if seed is None else [F.lit(seed)]
    for name in columns:
        value = F.col(f"`{name}`")
        if has_map(df.schema[name].dataType):
            value = F.to_json(F.struct(value.alias("v")))
        parts += [value, F.col(f"`{name}`").isNull()]
    return F.xxhash64(*parts)
