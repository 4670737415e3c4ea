"""What deleting or re-keying parents does to their children."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from goldspine.operators.joins import childless, lookup, referring


@dataclass(frozen=True)
class Deletion:
    """``remaining`` rows, the ids ``deleted``, ``blocked`` by children, ``missing``."""

    remaining: DataFrame
    deleted: DataFrame
    blocked: DataFrame
    missing: DataFrame


def delete_rows(parent: DataFrame, ids: DataFrame, pk: str, restricting: DataFrame | None = None, fk: str | None = None) -> Deletion:
    """Delete by id; with ``restricting`` children, a referenced row stays."""
    wanted = ids.select(pk).dropna().distinct()
    known = wanted.join(parent.select(pk), pk, "left_semi")
    missing = wanted.join(parent.select(pk), pk, "left_anti")
    if restricting is None:
        deleted, blocked = known, known.limit(0)
    else:
        deleted = childless(known, restricting, pk, fk or pk)
        blocked = referring(known, restricting, pk, fk or pk)
    return Deletion(parent.join(deleted, pk, "left_anti"), deleted, blocked, missing)


def set_null(child: DataFrame, deleted: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children of deleted parents lose their reference; all rows stay."""
    gone = deleted.select(F.col(pk).alias(fk)).distinct().withColumn("_gone", F.lit(True))
    joined = lookup(child, gone, [fk], "left")
    cleared = F.when(F.col("_gone").isNull(), F.col(fk))
    return joined.withColumn(fk, cleared).select(*child.columns)


def cascade_delete(child: DataFrame, deleted: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children of deleted parents are deleted with them."""
    gone = deleted.select(F.col(pk).alias(fk)).distinct()
    return lookup(child, gone, [fk], "left_anti").select(*child.columns)


def cascade_key(
    child: DataFrame, moves: DataFrame, fk: str, old: str = "old_key", new: str = "new_key"
) -> DataFrame:
    """Children follow a parent's new key; ``moves`` names each old key once."""
    mapping = moves.select(F.col(old).alias(fk), F.col(new).alias("_new_key"), F.lit(True).alias("_moved"))
    joined = lookup(child, mapping, [fk], "left")
    followed = F.when(F.col("_moved"), F.col("_new_key")).otherwise(F.col(fk)).cast(child.schema[fk].dataType)
    return joined.withColumn(fk, followed).select(*child.columns)
