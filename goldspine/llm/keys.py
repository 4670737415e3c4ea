"""Columns that identify a row of texts inside the operators.

Every operator first projects its input to the columns below, so further
columns of the input, whatever their names, neither clash nor travel along.

* ``_id``: the id as a long; a null id ranks first, as the smallest long. Ids
  must be whole numbers, or text of such: anything else ends the job.
* ``_fp``: a hash of the text. Rows that share an id but not a text stay apart;
  rows that share both are copies of one row and get the same result each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NO_ID = -(1 << 63)
ID, FP, TEXT = "_id", "_fp", "_text"


def keyed(rows: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """``_id, _fp, _text`` and ``more``; names are taken as they are, dots and all."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rank = F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID))
    return rows.select(rank.alias(ID), F.xxhash64(text).alias(FP), text.alias(TEXT), *more)


def public_id(name: str) -> Column:
    """The id as it came."""
    return F.when(F.col(ID) != NO_ID, F.col(ID)).alias(name)


def buckets(spark: SparkSession, total_bytes: int) -> int:
    """So many groups that each fits a task, and some for each shuffle partition.

    A group stands for 4 MiB of texts; beyond 64 GiB it grows with the corpus,
    to 64 MiB at most.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * partitions, -(-total_bytes // min(max(4 << 20, total_bytes >> 14), 64 << 20)))


def text_bytes(rows: DataFrame) -> int:
    return int(rows.agg(F.sum(F.octet_length(TEXT))).first()[0] or 0)


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python a thousand at a time, unless the session says otherwise.

    Ten thousand, the default, are tens of MB outside the heap for each task.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting, "10000") == "10000":
        spark.conf.set(setting, "1000")
