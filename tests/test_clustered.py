"""Sorted files with an index: pages, keys, filters."""

import pytest
from pyspark.sql import functions as F

from goldspine.sinks.clustered import page_at, rows_with_key, write_clustered


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """10,000 rows: null keys, a key with a third of all rows, and all others once."""
    rows = spark.range(0, 10_000, 1, 4).select(
        F.when(F.col("id") % 1000 == 7, None).when(F.col("id") % 3 == 0, 4000).otherwise(F.col("id")).alias("k.k"), F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
    )
    return write_clustered(rows, "k.k", str(tmp_path_factory.mktemp("c") / "a b"), 700, bloom=["name"])


def test_pages_hold_each_row_once_in_order(spark, table):
    seen = []
    for offset in range(0, 10_500, 500):
        page = page_at(spark, table, 500, offset)
        assert len(page.inputFiles()) <= 3
        seen += [(r["k.k"], r.n) for r in page.collect()]
    keys = [k for k, _ in seen]
    assert sorted(n for _, n in seen) == list(range(10_000))
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert keys[:11].count(None) == 10


def test_deep_page_reads_few_files(spark, tmp_path):
    path = write_clustered(spark.range(2_100_000).select((2_100_000 - F.col("id")).alias("id")), "id", str(tmp_path / "t"), 50_000)
    page = page_at(spark, path, 100, 1_000_000)
    assert [r.id for r in page.collect()] == list(range(1_000_001, 1_000_101))
    assert len(page.inputFiles()) <= 2 < len(spark.read.parquet(f"{path}/rows").inputFiles())


def test_rows_with_key(spark, table):
    assert rows_with_key(spark, table, "k.k", 4000).count() == sum(n % 3 == 0 and n % 1000 != 7 for n in range(10_000)) + 1
    one = rows_with_key(spark, table, "k.k", 5000)
    assert [r.n for r in one.collect()] == [5000] and len(one.inputFiles()) <= 2
    for absent in (-1, 3, 99_999):
        assert rows_with_key(spark, table, "k.k", absent).count() == 0


def test_empty_table_and_bounds(spark, tmp_path):
    path = write_clustered(spark.range(0), "id", str(tmp_path / "t"))
    assert page_at(spark, path).collect() == [] and rows_with_key(spark, path, "id", 1).collect() == []
    for limit, offset in ((0, 0), (501, 0), (1, -1)):
        with pytest.raises(ValueError):
            page_at(spark, path, limit, offset)


def test_bloom_filters_are_written(spark, table):
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = spark.read.parquet(f"{table}/rows").inputFiles()
    reader = footer.open(spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path(f"{table}/rows/{files[0].rsplit('/', 1)[1]}"), spark._jsc.hadoopConfiguration()))
    columns = list(reader.getFooter().getBlocks().get(0).getColumns())
    reader.close()
    held = {c.getPath().toDotString(): c.getBloomFilterOffset() >= 0 for c in columns}
    assert held["name"] and not held["n"]
