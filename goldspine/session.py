"""Session settings used by the tests and the bench; a cluster brings its own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(
    app: str = "goldspine", cores: int | str = "*", partitions: int = 8, java_options: str = ""
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GOLDSPINE_DRIVER_MEMORY", "8g"))
    )
    if java_options:
        builder = builder.config("spark.driver.extraJavaOptions", java_options)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


_LOCAL_SHARED: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _LOCAL_SHARED.setdefault("dir", tempfile.mkdtemp(prefix="goldspine-"))
