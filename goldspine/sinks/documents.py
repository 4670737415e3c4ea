"""Tables and small documents under versioned names."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F


def slug() -> str:
    """UTC second as ``YYYYMMDDTHHMMSSZ``, the suffix of every output."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def write_table(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "errorifexists", **options: str) -> str:
    """Write all rows; the job's commit makes the output appear whole or not at all."""
    writer = df.write.mode(mode)
    if file_format == "csv":
        options = {"header": "true", "encoding": "UTF-8", "escape": '"', **options}
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.format(file_format).save(path)
    return path


def write_document(spark: SparkSession, document: Any, path: str) -> str:
    """A single JSON value (a report, a manifest) as a one-line text output."""
    text = json.dumps(document, ensure_ascii=False, default=str)
    spark.range(0, 1, 1, 1).select(F.lit(text).alias("value")).write.text(path)
    return path


def lineage(frames: dict[str, DataFrame]) -> DataFrame:
    """(source, path) of every file behind frames that come straight from files."""
    rows = None
    for name, frame in frames.items():
        files = frame.select(F.lit(name).alias("source"), F.col("_metadata.file_path").alias("path")).distinct()
        rows = files if rows is None else rows.unionAll(files)
    return rows
