"""Set-based insert-or-update and the ids of new rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from goldspine.operators.joins import lookup
from goldspine.sinks.staging import stage

CHANGE = "_change"


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``target`` after applying ``incoming`` by natural key, with a change label.

    Both sides hold each key once and no null key. ``columns`` are taken from
    the incoming row (default: all it has besides the key); other columns keep
    the target's value. ``on_update`` and ``on_insert`` set a column by
    expression on touched rows. ``_change`` is inserted, updated or kept.
    """
    columns = [c for c in (columns or incoming.columns) if c not in keys]
    on_update, on_insert = on_update or {}, on_insert or {}
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(F.lit(True).alias("_here"), *rest).alias("_old"))
    new = incoming.select(*keys, F.struct(F.lit(True).alias("_here"), *columns).alias("_new"))
    joined = old.join(new, list(keys), "full_outer")
    has_old, has_new = F.col("_old._here").isNotNull(), F.col("_new._here").isNotNull()

    def value(name: str) -> Column:
        kept = F.col(f"_old.{name}")
        result = F.when(has_new, F.col(f"_new.{name}")).otherwise(kept) if name in columns else kept
        if name in on_update:
            result = F.when(has_old & has_new, on_update[name]).otherwise(result)
        if name in on_insert:
            result = F.when(~has_old, on_insert[name]).otherwise(result)
        return result.cast(target.schema[name].dataType).alias(name)

    change = F.when(~has_old, "inserted").when(has_new, "updated").otherwise("kept")
    return joined.select(
        *[F.col(name) if name in keys else value(name) for name in target.columns], change.alias(CHANGE)
    )


def new_keys(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-null natural keys of ``incoming`` that ``target`` (unique) lacks."""
    wanted = incoming.select(*keys).dropna().distinct()
    return wanted.join(target.select(*keys), list(keys), "left_anti")


def assign_ids(rows: DataFrame, id_column: str, start: int) -> DataFrame:
    """Number ``rows`` densely from ``start + 1`` without a sort.

    The rows are staged first, so a number is a fact about a written file:
    rows in earlier files plus the row's own position. No retry can change it.
    """
    staged = stage(rows, id_column)
    placed = staged.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    # One row per written file.
    files = staged.select(F.col("_metadata.file_name").alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = (F.lit(start) + F.col("_before") + F.col("_row") + 1).cast("bigint")
    return lookup(placed, files, ["_file"], "inner").select(
        number.alias(id_column), *[F.col(c) for c in rows.columns]
    )


def resolve_ids(rows: DataFrame, dimension: DataFrame, keys: Sequence[str], id_column: str) -> DataFrame:
    """Attach the surrogate id of each row's natural key; null where unknown.

    A natural key may be shared by any number of rows.
    """
    return lookup(rows, dimension.select(*keys, id_column), keys, "left")
