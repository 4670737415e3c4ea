"""Tables laid out for reads by id: sorted files, and an index with the place of each file's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from goldspine.operators.access import DEFAULT_LIMIT, check_page

ROWS_PER_FILE = 1_000_000


def write_clustered(
    df: DataFrame, key: str, path: str, rows_per_file: int = ROWS_PER_FILE, bloom: Sequence[str] = ()
) -> str:
    """Write ``df`` in order of ``key`` and index its files; returns ``path``.

    Rows are dealt to tasks by ranges of the key, once, and sorted there; a
    null key comes first. Different rows of one key are spread by their hash,
    so a key with many rows takes many tasks. Each file is a run of that order, so the index, a
    row for each file, tells which files hold a place or a key. ``bloom``
    names further columns that are looked up by value: row groups without the
    value are skipped.
    """
    column = F.col(f"`{key}`")
    order = column, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", rows_per_file)
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", True)
    writer.parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    files = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"),
        # A structure, since a null key counts as the least.
        F.min(F.struct(column.alias("key"))).alias("low"),
        F.max(F.struct(column.alias("key"))).alias("high"),
    )
    # The running sum is over files, not rows: a million of them hold 10^12 rows.
    before = F.sum("rows").over(Window.orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1))
    files.withColumn("first_row", F.coalesce(before, F.lit(0))).write.parquet(f"{path}/index")
    return path


def _files(spark: SparkSession, path: str, wanted: Column) -> tuple[DataFrame, dict[str, int]]:
    """The rows of the files whose index entry is ``wanted``, and the place of each file's first row."""
    first = {r["file"]: r["first_row"] for r in spark.read.parquet(f"{path}/index").where(wanted).select("file", "first_row").collect()}
    every = spark.read.parquet(f"{path}/rows")
    if not first:
        return every.limit(0), first
    return spark.read.schema(every.schema).parquet(*[f"{path}/rows/{name}" for name in first]), first


def page_at(spark: SparkSession, path: str, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """One page in key order at any depth: only the files that hold it are read.

    Rows of one key keep the order in which they are stored, so the pages of a
    table hold each row once. Behind the last row a page is empty.
    """
    check_page(limit, offset)
    rows, first = _files(spark, path, (F.col("first_row") < offset + limit) & (F.col("first_row") + F.col("rows") > offset))
    if not first:
        return rows
    # At most a page's files: a map of literals.
    starts = F.create_map(*[F.lit(x) for entry in first.items() for x in entry])
    place = starts[F.col("_metadata.file_name")] + F.col("_metadata.row_index")
    numbered = rows.select("*", place.alias("_place")).where(F.col("_place").between(offset, offset + limit - 1))
    return numbered.orderBy("_place").drop("_place")


def rows_with_key(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """The rows of one key, from the files whose range of keys holds it."""
    held = (F.col("low.key") <= F.lit(value)) | F.col("low.key").isNull()
    rows, _ = _files(spark, path, held & (F.col("high.key") >= F.lit(value)))
    return rows.where(F.col(f"`{key}`") == F.lit(value))
