"""Analytic queries: counts, latest rows, ranks, statistics, top rows, bound SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldspine.operators.aggregates import group_counts, key_summary, duplicate_count
from goldspine.operators.dedupe import first_per_key, latest_per_key
from goldspine.operators.ranking import dense_rank_within, top_k_by_measure
from goldspine.plans import analytics as plans
from goldspine.sources.tables import run_sql, scan_active
from goldspine.suite.tables import as_double, customers, day, read, shipments, suppliers

TOP = 10_000
YEAR = 1998


def entities_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return group_counts(customers(spark, sf), "region_name", 1, F.col("active"))


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return plans.latest_indicators(
        suppliers(spark, sf),
        shipments(spark, sf),
        minimum_population=5,
        key="s_suppkey",
        period="l_shipdate",
        tie_break=("l_orderkey", "l_linenumber", "l_partkey", "population", "gdp_usd", "area_km2"),
        name="s_name",
    )


def latest_indicator_ranked(spark: SparkSession, sf: str) -> DataFrame:
    ranked = _latest(spark, sf).withColumn("l_shipdate", day("l_shipdate"))
    return as_double(ranked, "density_per_km2", "gdp_per_capita_usd")


def region_statistics(spark: SparkSession, sf: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    year = shipments(spark, sf).where(
        (shipped >= F.lit(f"{YEAR}-01-01").cast("timestamp_ntz"))
        & (shipped < F.lit(f"{YEAR + 1}-01-01").cast("timestamp_ntz"))
    )
    stats = plans.region_statistics(
        suppliers(spark, sf),
        year.withColumn("year", F.year("l_shipdate")),
        indicator_year=YEAR,
        minimum_total_population=100,
        key="s_suppkey",
    )
    stats = stats.withColumn("total_population", F.col("total_population").cast("bigint"))
    return as_double(stats, "average_population", "total_gdp_usd", "weighted_gdp_per_capita_usd")


def topk_measure(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    usable = orders.where(F.col("o_custkey").isNotNull() & F.col("o_totalprice").isNotNull())
    return top_k_by_measure(usable, "o_totalprice", ("o_orderkey",), TOP)


def latest_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    latest = latest_per_key(orders, ["o_custkey"], "o_orderdate", ("o_orderkey",))
    return latest.withColumn("o_orderdate", day("o_orderdate"))


def first_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's cheapest order, the newest of equally cheap ones."""
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return first_per_key(orders, ["o_custkey"], [F.col("o_totalprice").asc_nulls_last(), F.col("o_orderkey").desc()])


def rank_in_group(spark: SparkSession, sf: str) -> DataFrame:
    """Orders ranked by price within their priority."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return dense_rank_within(orders, "o_orderpriority", "o_totalprice", "price_rank")


def rank_in_large_group(spark: SparkSession, sf: str) -> DataFrame:
    """Line items ranked by price within their flag, a few groups that hold all rows."""
    lines = read(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    return dense_rank_within(lines, "l_returnflag", "l_extendedprice", "price_rank")


def active_scan(spark: SparkSession, sf: str) -> DataFrame:
    table = read(spark, sf, "customer").withColumn("active", F.col("c_acctbal") > 0)
    return scan_active(table, "c_custkey").select("c_custkey", "c_name", "c_mktsegment")


def bound_sql(spark: SparkSession, sf: str) -> DataFrame:
    text = """
        SELECT o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS highest
        FROM {orders} WHERE o_totalprice >= :minimum AND o_orderstatus <> :excluded
        GROUP BY o_orderpriority HAVING count(*) >= :fewest ORDER BY n_orders DESC, o_orderpriority
    """
    params = {"minimum": 1000, "excluded": "P", "fewest": 10}
    return run_sql(spark, text, params, orders=read(spark, sf, "orders"))


def uniqueness_summary(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem").withColumn(
        "line_key", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    return key_summary(lines, ["l_orderkey", "line_key"], duplicate_lines=duplicate_count("line_key"))


QUERIES = {
    "entities_by_region": entities_by_region,
    "latest_indicator_ranked": latest_indicator_ranked,
    "region_statistics": region_statistics,
    "topk_measure": topk_measure,
    "latest_per_entity": latest_per_entity,
    "first_per_entity": first_per_entity,
    "rank_in_group": rank_in_group,
    "rank_in_large_group": rank_in_large_group,
    "active_scan": active_scan,
    "bound_sql": bound_sql,
    "uniqueness_summary": uniqueness_summary,
}

ORACLES = {
    "entities_by_region": """
        SELECT r_name AS region_name, count(*) AS country_count
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_acctbal > 0 GROUP BY r_name HAVING count(*) >= 1
        ORDER BY country_count DESC, region_name
    """,
    "latest_indicator_ranked": """
        WITH numbered AS (
            SELECT l_suppkey, l_shipdate, CAST(l_quantity AS BIGINT) AS population,
                   l_discount AS area_km2, l_extendedprice AS gdp_usd,
                   row_number() OVER (
                       PARTITION BY l_suppkey
                       ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
                                l_quantity DESC, l_extendedprice DESC, l_discount DESC) AS rn
            FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount > 0
        ), joined AS (
            SELECT s_suppkey, s_name, n_name AS subregion_name, r_name AS region_name,
                   CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, population, area_km2, gdp_usd,
                   CAST(round(area_km2 * 100) AS BIGINT) AS area_cents,
                   CAST(round(gdp_usd * 100) AS BIGINT) AS gdp_cents
            FROM supplier JOIN numbered ON l_suppkey = s_suppkey AND rn = 1
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            WHERE s_acctbal > 0 AND population >= 5
        )
        SELECT s_suppkey, s_name, subregion_name, region_name, l_shipdate, population, area_km2, gdp_usd,
               CAST((2 * population * 10000 + area_cents) // (2 * area_cents) AS DOUBLE) / 100 AS density_per_km2,
               CASE WHEN population = 0 THEN NULL
                    ELSE CAST((2 * gdp_cents + population) // (2 * population) AS DOUBLE) / 100
               END AS gdp_per_capita_usd,
               dense_rank() OVER (PARTITION BY region_name ORDER BY population DESC) AS population_rank_in_region
        FROM joined ORDER BY region_name, population_rank_in_region, s_name
    """,
    "region_statistics": f"""
        WITH facts AS (
            SELECT r_name AS region_name, CAST(l_quantity AS BIGINT) AS q,
                   CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
            FROM supplier JOIN lineitem ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            WHERE s_acctbal > 0 AND year(l_shipdate) = {YEAR}
        ), sums AS (
            SELECT region_name, count(*) AS n, CAST(sum(q) AS BIGINT) AS q, CAST(sum(cents) AS BIGINT) AS cents
            FROM facts GROUP BY region_name HAVING sum(q) >= 100
        )
        SELECT region_name, n AS country_count, q AS total_population,
               CAST((2 * q + n) // (2 * n) AS DOUBLE) AS average_population,
               CAST(cents AS DOUBLE) / 100 AS total_gdp_usd,
               CAST((2 * cents + q) // (2 * q) AS DOUBLE) / 100 AS weighted_gdp_per_capita_usd
        FROM sums ORDER BY total_population DESC
    """,
    "topk_measure": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
        WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL
        ORDER BY o_totalprice DESC, o_orderkey LIMIT {TOP}
    """,
    "latest_per_entity": """
        SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderkey, o_totalprice
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
    "first_per_entity": """
        SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey DESC) = 1
    """,
    "rank_in_group": """
        SELECT o_orderkey, o_orderpriority, o_totalprice,
               dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS price_rank
        FROM orders
    """,
    "rank_in_large_group": """
        SELECT l_returnflag, l_quantity, l_extendedprice,
               dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS price_rank
        FROM lineitem
    """,
    "active_scan": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0 ORDER BY c_custkey",
    "bound_sql": """
        SELECT o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS highest FROM orders
        WHERE o_totalprice >= 1000 AND o_orderstatus <> 'P'
        GROUP BY o_orderpriority HAVING count(*) >= 10
    """,
    "uniqueness_summary": """
        SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_l_orderkey,
               count(DISTINCT concat(l_orderkey, '-', l_linenumber)) AS distinct_line_key,
               count(*) - count(DISTINCT concat(l_orderkey, '-', l_linenumber)) AS duplicate_lines
        FROM lineitem
    """,
}
