"""Cut a lineage by writing the frame to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from goldspine.session import shared_dir


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/goldspine/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: later uses neither recompute nor depend on any executor.

    Parquet keeps column pruning, filters and true sizes for the plans that follow.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
