"""Relational sources and parameterised SQL."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F


def scan_active(table: DataFrame, order: str, active: str = "active", state: bool = True) -> DataFrame:
    """Rows in the given state, ordered."""
    return table.where(F.col(active) == F.lit(state)).orderBy(F.col(order).asc_nulls_last())


def read_jdbc(spark: SparkSession, url: str, table: str, split_column: str, low: int, high: int, splits: int, **options: str) -> DataFrame:
    """A database table read by ``splits`` tasks, each bound to a range of ``split_column``."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_column,
        lowerBound=str(low), upperBound=str(high), numPartitions=str(splits),
    )
    return reader.options(**options).load()


def run_sql(spark: SparkSession, text: str, params: Mapping[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """A SQL text with bound ``:name`` parameters over views, or over ``{frames}``."""
    if not text.strip():
        raise ValueError("empty SQL text")
    return spark.sql(text, args=dict(params or {}), **frames)


def read_sql_file(spark: SparkSession, path: str) -> str:
    """The text of one SQL file from any file system Spark can read."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None or not text[0].strip():
        raise ValueError(f"empty SQL file: {path}")
    return text[0].strip().rstrip(";")
