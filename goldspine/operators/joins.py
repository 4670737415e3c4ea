"""Joins of rows to the unique rows they refer to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def lookup(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``many`` to ``one``, which holds each key once, on equal column names.

    ``how`` is left, inner, left_semi or left_anti. It is a plain join, so
    columns are pruned and filters pushed on both sides; a key of ``many`` may
    hold any share of its rows, since adaptive execution splits its partition.
    Spark broadcasts ``one`` by itself where its measured size allows.
    """
    if how not in {"left", "inner", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported lookup: {how}")
    return many.join(one, list(keys), how)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows of ``child`` whose non-null ``fk`` has no ``pk`` in ``parent``.

    The parent keys are reduced to distinct ones first, inside the map tasks.
    """
    keys = parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()).distinct()
    return lookup(child.where(F.col(fk).isNotNull()), keys, [fk], "left_anti")


def childless(parent: DataFrame, child: DataFrame, pk: str, fk: str) -> DataFrame:
    """Rows of ``parent`` (unique ``pk``) that no ``child`` refers to."""
    referred = child.select(F.col(fk).alias(pk)).where(F.col(pk).isNotNull()).distinct()
    return parent.join(referred, pk, "left_anti")


def referring(parent: DataFrame, child: DataFrame, pk: str, fk: str) -> DataFrame:
    """Rows of ``parent`` (unique ``pk``) that some ``child`` refers to."""
    referred = child.select(F.col(fk).alias(pk)).where(F.col(pk).isNotNull()).distinct()
    return parent.join(referred, pk, "left_semi")
