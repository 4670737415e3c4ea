"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "_rank_in_key"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under any ``order``; null keys form one group.

    ``order`` must be total, or ties are settled arbitrarily. Every task keeps
    one row per key before the shuffle (a partial group limit), so a key that
    holds a third of all rows sends one row per task. Where the order is
    "highest first", ``highest_per_key`` sorts less.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def highest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is highest in the ``order`` columns, nulls lowest.

    An aggregate over whole rows: map tasks reduce each key to one row, and
    only the keys are sorted, not the rows within a key. All columns of ``df``
    are carried, so select the wanted ones first. Ties go to the row that is
    highest in the remaining columns, as far as their types have an order.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [F.col(f"`{name}`") for name in order]
    others = [F.col(f"`{name}`") for name in rest]
    if all(_orderable(df.schema[name].dataType) for name in rest):
        best = F.max(F.struct(*[c.alias(f"_{i}") for i, c in enumerate([*ranked, *others])]))
        carried = [*order, *rest]
    else:
        carried = [c for c in df.columns if c not in keys]
        row = F.struct(*[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(carried)])
        best = F.max_by(row, F.struct(*ranked))
    place = {name: i for i, name in enumerate(carried) if name not in keys}
    picked = df.groupBy(*keys).agg(best.alias("_row"))
    return picked.select(
        *[F.col(f"`{c}`") if c in keys else F.col(f"_row._{place[c]}").alias(c) for c in df.columns]
    )


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(field.dataType) for field in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], period: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The row of the latest ``period`` per key; a null period never wins."""
    return highest_per_key(df, keys, (period, *tie_break))


def keep_last(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """The last row of each key in input order, given by the ``ordinal`` columns."""
    return highest_per_key(df, keys, ordinal)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


class DuplicateKeys(ValueError):
    """A one-to-one match met a repeated key."""


def assert_unique(df: DataFrame, keys: Sequence[str], role: str) -> None:
    """Raise if a non-null key repeats; reads back a single example."""
    probe = duplicate_keys(df.dropna(subset=list(keys)), keys).limit(1).collect()
    if probe:
        raise DuplicateKeys(f"{role}: key {probe[0].asDict()} is not unique")
