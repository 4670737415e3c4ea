"""Collections of short labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from goldspine.functions.text import strip

SEPARATOR = "|"


def sorted_labels(values: Column) -> Column:
    """Distinct, trimmed, non-blank entries in code-point order."""
    trimmed = F.transform(values, lambda item: strip(item.cast("string")))
    return F.array_sort(F.array_distinct(F.filter(trimmed, lambda item: item.isNotNull() & (item != ""))))


def serialize(value: Column, dtype: T.DataType) -> Column:
    """Text form of an array, a map (its keys) or a scalar; empty is null."""
    if isinstance(dtype, T.MapType):
        value, dtype = F.map_keys(value), T.ArrayType(dtype.keyType)
    if isinstance(dtype, T.ArrayType):
        return F.nullif(F.array_join(sorted_labels(value), SEPARATOR), F.lit(""))
    return F.nullif(strip(value.cast("string")), F.lit(""))
