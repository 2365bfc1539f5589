"""Order-free checksums over whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType)


def hashable(c: Column, dtype: T.DataType) -> Column:
    """A value that hash functions accept: maps, at any depth, become sorted arrays of entries."""
    if isinstance(dtype, T.MapType):
        entries = F.map_entries(c)
        entry = lambda e: F.struct(hashable(e["key"], dtype.keyType).alias("key"),
                                   hashable(e["value"], dtype.valueType).alias("value"))
        return F.array_sort(F.transform(entries, entry))
    if isinstance(dtype, T.ArrayType) and has_map(dtype):
        return F.transform(c, lambda x: hashable(x, dtype.elementType))
    if isinstance(dtype, T.StructType) and has_map(dtype):
        return F.when(c.isNotNull(), F.struct(*[hashable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    return c


def content_checksum(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """An aggregate: the sum of the rows' 64-bit hashes over ``cols`` (all, by name, if not given)."""
    cols = sorted(df.columns) if cols is None else cols
    # a decimal(38,0) sum: a bigint sum of 64-bit hashes overflows under ANSI mode
    return F.sum(F.xxhash64(*[hashable(F.col(f"`{c}`"), df.schema[c].dataType) for c in cols]).cast("decimal(38,0)"))
