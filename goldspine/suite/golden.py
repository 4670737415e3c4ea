"""Golden customer records from five overlapping sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldspine.config import Consolidation, Ratio
from goldspine.operators.aggregates import rows_per_source
from goldspine.operators.quality import QualityConfig, quality_checks
from goldspine.plans.consolidate import merge_sources
from goldspine.plans.standardize import Standard, standardize
from goldspine.suite.tables import customers, read

CONFIG = Consolidation(
    spine="file",
    key="entity",
    name="entity_name",
    name_key="entity_key",
    spine_columns=("entity_name", "segment"),
    canonical=(
        "entity bigint, entity_name string, segment string, capital string, region string, subregion string, "
        "population bigint, area_km2 double, gdp_usd double, density_per_km2 double, gdp_per_capita_usd double, "
        "source_count bigint, sources string"
    ),
    priority={
        "entity_name": ("file", "api", "database", "bigdata", "scraping"),
        "capital": ("api",),
        "region": ("database", "api"),
        "subregion": ("database", "api"),
        "population": ("bigdata", "scraping", "api"),
        "area_km2": ("bigdata", "api"),
        "gdp_usd": ("bigdata",),
    },
    quality=QualityConfig(
        mandatory=("entity", "entity_name", "region"),
        unique=("entity", "entity_name", "region"),
        code_lengths={"segment": 9},
        non_negative=("population",),
        positive=("area_km2",),
        minimum_sources=3,
    ),
    ratios=(
        Ratio("density_per_km2", "population", "area_km2"),
        Ratio("gdp_per_capita_usd", "gdp_usd", "population"),
    ),
)
_NAMED = {"name": "entity_name", "name_key": "entity_key"}
SPECS = {
    "file": Standard("file", ("entity", "entity_name", "segment"), ("entity",), ("entity", "entity_name"), **_NAMED),
    "api": Standard(
        "api", ("entity", "entity_name", "capital", "region", "subregion", "population", "area_km2"), ("entity",),
        integers=("population",), doubles=("area_km2",), renames={"event_type": "capital"}, **_NAMED,
    ),
    "scraping": Standard(
        "scraping", ("entity_name", "population"), ("entity_key",), ("entity_name",),
        renames={"population_scraped": "population"}, integers=("population",), drop_null_key=True, **_NAMED,
    ),
    "database": Standard(
        "database", ("entity", "entity_name", "region", "subregion"), ("entity",),
        renames={"region_name": "region", "subregion_name": "subregion"}, **_NAMED,
    ),
    "bigdata": Standard(
        "bigdata", ("entity", "entity_name", "year", "population", "area_km2", "gdp_usd"), ("entity",),
        integers=("population",), doubles=("area_km2", "gdp_usd"), period="year", **_NAMED,
    ),
}


def _raw(spark: SparkSession, sf: str, source: str) -> tuple[DataFrame, str]:
    """A source's rows as they might arrive, and the column that orders them."""
    if source == "file":
        return read(spark, sf, "customer").select(
            F.col("c_custkey").alias("entity"), F.col("c_name").alias("entity_name"), F.col("c_mktsegment").alias("segment"),
            F.col("c_custkey").alias("seq"),
        ), "seq"
    if source == "api":
        return read(spark, sf, "events").select(
            F.col("user_id").alias("entity"), F.concat(F.lit("User "), "user_id").alias("entity_name"), "event_type",
            F.concat(F.get_json_object("props", "$.k"), F.lit(" people")).alias("population"),
            F.when(F.col("value") > 0, F.col("value")).alias("area_km2"), F.col("event_id").alias("seq"),
        ), "seq"
    orders = read(spark, sf, "orders")
    if source == "scraping":
        name = F.concat(F.lit(" CUSTOMER # "), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(" ["), "o_orderkey", F.lit("]"))
        return orders.select(
            name.alias("entity_name"), F.format_number(F.floor("o_totalprice"), 0).alias("population_scraped"),
            F.col("o_orderkey").alias("seq"),
        ), "seq"
    if source == "database":
        return customers(spark, sf).where("active").select(
            F.col("c_custkey").alias("entity"), F.col("c_name").alias("entity_name"), "region_name", "subregion_name",
            F.col("c_custkey").alias("seq"),
        ), "seq"
    return orders.select(
        F.col("o_custkey").alias("entity"), F.concat(F.lit("Buyer "), "o_custkey").alias("entity_name"),
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice")).alias("population"),
        F.col("o_totalprice").alias("gdp_usd"), F.col("o_orderkey").alias("seq"),
    ), "seq"


def source(spark: SparkSession, sf: str, name: str) -> DataFrame:
    raw, ordinal = _raw(spark, sf, name)
    return standardize(raw, SPECS[name], {}, (ordinal,))


def sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: source(spark, sf, name) for name in SPECS}


def golden_record_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge_sources(sources(spark, sf), CONFIG)


def golden_record_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_checks(golden_record_merge(spark, sf), CONFIG.quality)


def source_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rows_per_source(sources(spark, sf))


QUERIES = {
    "golden_record_merge": golden_record_merge,
    "golden_record_quality": golden_record_quality,
    "source_row_counts": source_row_counts,
    **{f"standardize_{name}": (lambda spark, sf, _n=name: source(spark, sf, _n)) for name in SPECS},
}

_SOURCES = r"""
    file AS (
        SELECT c_custkey AS entity, c_name AS entity_name, c_mktsegment AS segment,
               regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g') AS entity_key, 'file' AS source
        FROM customer
    ), api AS (
        SELECT user_id AS entity, concat('User ', user_id) AS entity_name, event_type AS capital,
               CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS subregion,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS population,
               CASE WHEN value > 0 THEN value END AS area_km2,
               concat('user ', user_id) AS entity_key, 'api' AS source
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
    ), scraping AS (
        SELECT concat(' CUSTOMER # ', lpad(CAST(o_custkey AS VARCHAR), 9, '0'), ' [', o_orderkey, ']') AS entity_name,
               CAST(floor(o_totalprice) AS BIGINT) AS population,
               concat('customer ', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS entity_key, 'scraping' AS source
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
    ), database AS (
        SELECT c_custkey AS entity, c_name AS entity_name, r_name AS region, n_name AS subregion,
               regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g') AS entity_key, 'database' AS source
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_acctbal > 0
    ), bigdata AS (
        SELECT o_custkey AS entity, concat('Buyer ', o_custkey) AS entity_name,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS population,
               CAST(NULL AS DOUBLE) AS area_km2, o_totalprice AS gdp_usd,
               concat('buyer ', o_custkey) AS entity_key, 'bigdata' AS source
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey DESC) = 1
    )
"""
_GOLDEN = f"""
    WITH {_SOURCES}, merged AS (
        SELECT file.entity, file.entity_name, file.segment, api.capital,
               coalesce(database.region, api.region) AS region,
               coalesce(database.subregion, api.subregion) AS subregion,
               coalesce(bigdata.population, scraping.population, api.population) AS population,
               coalesce(bigdata.area_km2, api.area_km2) AS area_km2, bigdata.gdp_usd,
               1 + (api.entity_name IS NOT NULL)::BIGINT + (scraping.entity_name IS NOT NULL)::BIGINT
                 + (database.entity_name IS NOT NULL)::BIGINT + (bigdata.entity_name IS NOT NULL)::BIGINT AS source_count,
               concat_ws('|', 'file', CASE WHEN api.entity_name IS NOT NULL THEN 'api' END,
                         CASE WHEN scraping.entity_name IS NOT NULL THEN 'scraping' END,
                         CASE WHEN database.entity_name IS NOT NULL THEN 'database' END,
                         CASE WHEN bigdata.entity_name IS NOT NULL THEN 'bigdata' END) AS sources
        FROM file LEFT JOIN api ON api.entity = file.entity LEFT JOIN database ON database.entity = file.entity
        LEFT JOIN bigdata ON bigdata.entity = file.entity LEFT JOIN scraping ON scraping.entity_key = file.entity_key
    ), golden AS (
        SELECT *, CAST(round(area_km2 * 100) AS BIGINT) AS area_cents,
               CAST(round(gdp_usd * 100) AS BIGINT) AS gdp_cents FROM merged
    ), final AS (
        SELECT entity, entity_name, segment, capital, region, subregion, population, area_km2, gdp_usd,
               CASE WHEN area_cents <> 0 THEN
                   CAST((2 * population * 10000 + area_cents) // (2 * area_cents) AS DOUBLE) / 100 END AS density_per_km2,
               CASE WHEN population <> 0 THEN
                   CAST((2 * gdp_cents + population) // (2 * population) AS DOUBLE) / 100 END AS gdp_per_capita_usd,
               source_count, sources
        FROM golden
    )
"""

ORACLES = {
    "golden_record_merge": f"{_GOLDEN} SELECT * FROM final ORDER BY entity",
    "golden_record_quality": f"""{_GOLDEN}
        SELECT count(*) AS final_rows,
               count(*) FILTER (WHERE entity IS NULL) AS null_entity,
               count(*) FILTER (WHERE entity_name IS NULL) AS null_entity_name,
               count(*) FILTER (WHERE region IS NULL) AS null_region,
               count(*) - count(DISTINCT entity) - max((entity IS NULL)::BIGINT) AS duplicate_entity,
               count(*) - count(DISTINCT entity_name) - max((entity_name IS NULL)::BIGINT) AS duplicate_entity_name,
               count(*) - count(DISTINCT region) - max((region IS NULL)::BIGINT) AS duplicate_region,
               count(*) FILTER (WHERE coalesce(length(segment) <> 9, true)) AS invalid_segment,
               count(*) FILTER (WHERE population < 0) AS negative_population,
               count(*) FILTER (WHERE area_km2 <= 0) AS non_positive_area_km2,
               count(*) FILTER (WHERE source_count < 3) AS rows_below_minimum_sources
        FROM final
    """,
    "source_row_counts": f"WITH {_SOURCES} "
    + " UNION ALL ".join(f"SELECT '{name}' AS source, count(*) AS rows FROM {name}" for name in SPECS),
    **{f"standardize_{name}": f"WITH {_SOURCES} SELECT * FROM {name}" for name in SPECS},
}
