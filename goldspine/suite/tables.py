"""The driver tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day(column: str):
    """A timestamp's date as text, the same in every engine."""
    return F.col(column).cast("date").cast("string")


def places(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = read(spark, sf, "nation"), read(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("subregion_name"), F.col("r_name").alias("region_name")
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as the reference entity."""
    joined = read(spark, sf, "customer").join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.withColumn("active", F.col("c_acctbal") > 0)


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as the reference entity of the line items."""
    joined = read(spark, sf, "supplier").join(places(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(
        "s_suppkey", "s_name", "subregion_name", "region_name", (F.col("s_acctbal") > 0).alias("active")
    )


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as indicators: whole quantity, discount as area, price as amount."""
    return read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"),
        "l_shipdate",
        F.col("l_quantity").cast("bigint").alias("population"),
        F.col("l_discount").alias("area_km2"),
        F.col("l_extendedprice").alias("gdp_usd"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in columns})
