"""Search, pages, point lookups and newest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldspine.operators.access import get_many, list_page, most_recent, page_after, search
from goldspine.sinks.clustered import page_at, write_clustered
from goldspine.sinks.staging import staging_path
from goldspine.suite.tables import day, read


def search_page(spark: SparkSession, sf: str) -> DataFrame:
    return list_page(read(spark, sf, "part"), "p_partkey", 100, 20, "p_name", "WIDG")


def search_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every document mentioning a literal with a wildcard sign in it, or a word."""
    documents = read(spark, sf, "documents")
    marked = search(documents, "text", "%").select("doc_id", F.lit("percent").alias("term"))
    return marked.unionAll(search(documents, "text", "ETION").select("doc_id", F.lit("word").alias("term")))


def keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return page_after(orders, "o_orderkey", 1000, 500)


def seek_page(spark: SparkSession, sf: str) -> DataFrame:
    """The page at two thirds of all orders, out of sorted files with an index."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = write_clustered(orders, "o_orderkey", staging_path(spark, "orders"), 20_000, bloom=["o_custkey"])
    return page_at(spark, path, 500, orders.count() * 2 // 3)


def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = read(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return get_many(suppliers, read(spark, sf, "events").select(F.col("user_id").alias("s_suppkey")), "s_suppkey")


def most_recent_rows(spark: SparkSession, sf: str) -> DataFrame:
    newest = most_recent(read(spark, sf, "orders"), "o_orderdate", 500, tie_break=("o_orderkey",))
    return newest.withColumn("o_orderdate", day("o_orderdate"))


QUERIES = {
    "search_page": search_page,
    "search_all": search_all,
    "keyset_page": keyset_page,
    "seek_page": seek_page,
    "point_lookup": point_lookup,
    "most_recent_rows": most_recent_rows,
}

ORACLES = {
    "search_page": "SELECT * FROM part WHERE p_name ILIKE '%widg%' ORDER BY p_partkey LIMIT 100 OFFSET 20",
    "search_all": """
        SELECT doc_id, 'percent' AS term FROM documents WHERE contains(text, '%')
        UNION ALL SELECT doc_id, 'word' FROM documents WHERE contains(lower(text), 'etion')
    """,
    "keyset_page": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500
    """,
    "seek_page": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_orderkey LIMIT 500 OFFSET (SELECT count(*) * 2 // 3 FROM orders)
    """,
    "point_lookup": """
        SELECT user_id AS s_suppkey, s_name, s_acctbal, s_suppkey IS NOT NULL AS found
        FROM events LEFT JOIN supplier ON s_suppkey = user_id
    """,
    "most_recent_rows": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(CAST(orders.o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
        FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey DESC LIMIT 500
    """,
}
