"""The whole run: five raw sources of the nations, golden records, the star, its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldspine.config import COUNTRIES, REPORT_NAMES
from goldspine.operators.quality import quality_report
from goldspine.plans import consolidate, extract, star_load
from goldspine.plans.star_store import StarStore
from goldspine.sinks.documents import write_table
from goldspine.sinks.staging import staging_path
from goldspine.suite.golden import CONFIG, ORACLES as GOLDEN_SQL, golden_record_merge, sources
from goldspine.suite.tables import places, read


AUDITED = ("status", "rows_read", "countries_inserted", "countries_updated", "indicators_upserted")


def _code() -> Column:
    letter = [F.chr(F.lit(65) + F.col("n_nationkey").cast("int") % 26), F.chr(F.lit(65) + F.floor(F.col("n_nationkey") / 26).cast("int"))]
    return F.concat(*letter)


def _jobs(spark: SparkSession, sf: str, root: str) -> dict:
    """A nation in each source: a code file, captured pages, web pages, a reference table, yearly totals of its customers' orders."""
    nation = places(spark, sf).select(
        "n_nationkey", _code().alias("iso2"), F.concat(_code(), F.lit("X")).alias("iso3"),
        F.col("subregion_name").alias("country_name"), "region_name",
    )
    customers = read(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    counted = nation.join(customers, F.col("c_nationkey") == F.col("n_nationkey"), "left").fillna(0, "customers")
    codes = write_table(nation.select("iso2", "iso3", "country_name"), f"{root}/in/codes", "csv")
    last = nation.agg(F.max("n_nationkey")).scalar()
    captured = counted.select(
        F.col("n_nationkey").cast("bigint").alias("page_offset"),
        F.concat(
            F.lit('{"data":{"objects":['),
            F.to_json(F.struct(
                F.col("iso2").alias("alpha2Code"), F.col("iso3").alias("alpha3Code"), F.col("country_name").alias("name"),
                F.concat(F.lit("Capital of "), "country_name").alias("capital"), F.lit("ignored").alias("region"),
                F.concat(F.lit("Sub"), F.col("n_nationkey") % 2).alias("subregion"), F.col("customers").alias("population"),
                F.array(F.lit("USD"), F.lit("EUR")).alias("currencies"), F.array(F.lit("spoken")).alias("languages"),
            )),
            F.lit('],"meta":{"more":'), F.when(F.col("n_nationkey") < last, "true").otherwise("false"), F.lit("}}}"),
        ).alias("payload"),
    )
    web = counted.select(
        F.concat(F.lit("http://web/"), "iso3").alias("url"),
        F.concat(
            F.lit('<table class="wikitable"><tr><th>Country</th><th>Population</th></tr><tr><td>'), F.initcap("country_name"),
            F.lit(" [1]</td><td>"), F.format_number(F.col("customers") * 1000, 0), F.lit("</td></tr></table>"),
        ).alias("html"),
    )
    reference = nation.select(
        "iso2", "iso3", "country_name", "region_name", F.concat(F.lit("Part of "), "region_name").alias("subregion_name"),
        (F.col("n_nationkey") % 3 != 0).alias("active"),
    )
    owner = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = read(spark, sf, "orders").join(owner, F.col("o_custkey") == F.col("c_custkey"))
    # A year's totals; every fifth nation has none.
    yearly = orders.where("c_nationkey % 5 != 0").groupBy("c_nationkey", F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("population"), F.sum(F.floor("o_totalprice")).cast("double").alias("gdp_usd")
    )
    indicators = write_table(
        yearly.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "iso3", "country_name", "year", "population", (F.col("n_nationkey") * 8.0 + 16).alias("area_km2"), "gdp_usd"
        ), f"{root}/in/indicators", "parquet",
    )
    return {
        "file": extract.file_job(spark, codes, root),
        "api": extract.api_job(spark, captured, "payload", "page_offset", "http://api", root),
        "scraping": extract.scraping_job(spark, web, "html", "url", root),
        "database": extract.database_job(spark, reference, root),
        "bigdata": extract.bigdata_job(spark, indicators, root),
    }


def five_sources_to_star(spark: SparkSession, sf: str) -> DataFrame:
    """The published tables, joined, after a load that was run twice; and what the audit says of the second."""
    root = staging_path(spark, "run")
    extract.extract(spark, _jobs(spark, sf, root), root)
    consolidate.run(spark, root)
    store = StarStore(spark, f"{root}/star")
    star_load.load_latest(spark, store, root)
    load = star_load.load_latest(spark, store, root)
    country, indicator = store.table("country"), store.table("country_indicator")
    named = country.join(store.table("region"), "region_id", "left").join(store.table("subregion").drop("region_id"), "subregion_id", "left")
    facts = named.join(indicator, "country_id", "left")
    audit = store.audit().where(F.col("load_id") == load["load_id"]).select(*AUDITED).first()
    decimals = [F.col(c).cast("double").alias(c) for c in ("area_km2", "gdp_usd", "density_per_km2", "gdp_per_capita_usd")]
    return facts.select(
        "iso2", "iso3", "country_name", "capital", "currencies", "languages", F.col("source_count").cast("int").alias("source_count"), "sources",
        "region_name", "subregion_name", "indicator_year", "population", *decimals,
        *[F.lit(audit[name]).alias(name) for name in AUDITED],
    )


def _under(block: str, counts: Column) -> Column:
    return F.transform_keys(counts, lambda name, _: F.concat(F.lit(f"{block}."), name))


def report_document(spark: SparkSession, sf: str) -> DataFrame:
    """The report on the golden customers as a document would hold it, a row for each entry."""
    report = quality_report(golden_record_merge(spark, sf), CONFIG.quality, sources(spark, sf), REPORT_NAMES)
    blocks = ("mandatory_nulls", "duplicates")
    counts = [f for f in report.schema["checks"].dataType.fieldNames() if f not in blocks]
    entries = F.map_concat(
        *[_under(b, F.col(f"checks.{b}")) for b in blocks],
        *[F.create_map(F.lit(f), F.col(f"checks.{f}")) for f in counts],
        _under("source_rows", F.col("source_rows")),
        F.create_map(F.lit("final_rows"), F.col("final_rows")),
    )
    return report.select("status", F.explode(entries).alias("entry", "n"))


QUERIES = {"five_sources_to_star": five_sources_to_star, "quality_report": report_document}

_CHECKS = {
    "mandatory_nulls.entity": "null_entity", "mandatory_nulls.entity_name": "null_entity_name", "mandatory_nulls.region": "null_region",
    "duplicates.entity": "duplicate_entity", "duplicates.entity_name": "duplicate_entity_name", "duplicates.region": "duplicate_region",
    "invalid_segment": "invalid_segment", "negative_population": "negative_population",
    "non_positive_area": "non_positive_area_km2", "rows_below_minimum_sources": "rows_below_minimum_sources",
}

ORACLES = {
    "five_sources_to_star": f"""
        WITH nations AS (
            SELECT n_nationkey AS k, chr(65 + CAST(n_nationkey % 26 AS INTEGER)) || chr(65 + CAST(n_nationkey // 26 AS INTEGER)) AS iso2,
                   n_name, r_name, count(c_custkey) AS customers
            FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL
        ), yearly AS (
            SELECT c_nationkey AS k, count(*) AS population, CAST(sum(floor(o_totalprice)) AS BIGINT) AS gdp
            FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 5 <> 0 GROUP BY c_nationkey, year(o_orderdate)
            QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY year(o_orderdate) DESC) = 1
        ), merged AS (
            SELECT nations.*, yearly.k IS NOT NULL AS counted, k % 3 <> 0 AS active, gdp,
                   CASE WHEN yearly.k IS NOT NULL THEN k * 8 + 16 END AS area, coalesce(population, customers * 1000) AS population
            FROM nations LEFT JOIN yearly USING (k)
        )
        SELECT iso2, iso2 || 'X' AS iso3, n_name AS country_name, 'Capital of ' || n_name AS capital, 'EUR|USD' AS currencies, 'spoken' AS languages,
               CAST(3 + active::INTEGER + counted::INTEGER AS INTEGER) AS source_count,
               'file|api|scraping' || CASE WHEN active THEN '|database' ELSE '' END || CASE WHEN counted THEN '|bigdata' ELSE '' END AS sources,
               CASE WHEN active THEN r_name ELSE 'ignored' END AS region_name,
               CASE WHEN active THEN 'Part of ' || r_name ELSE 'Sub' || (k % 2) END AS subregion_name,
               {star_load.DEFAULT_YEAR}::INTEGER AS indicator_year, population, CAST(area AS DOUBLE) AS area_km2, CAST(gdp AS DOUBLE) AS gdp_usd,
               CAST((200 * population + area) // (2 * area) AS DOUBLE) / 100 AS density_per_km2,
               CAST((200 * gdp + population) // (2 * population) AS DOUBLE) / 100 AS gdp_per_capita_usd,
               'success' AS status, CAST(count(*) OVER () AS INTEGER) AS rows_read, 0::INTEGER AS countries_inserted,
               CAST(count(*) OVER () AS INTEGER) AS countries_updated, CAST(count(*) OVER () AS INTEGER) AS indicators_upserted
        FROM merged
    """,
    "quality_report": f"""
        WITH checks AS ({GOLDEN_SQL["golden_record_quality"]}),
        entries AS ({" UNION ALL ".join(f"SELECT '{entry}' AS entry, {name} AS n FROM checks" for entry, name in _CHECKS.items())})
        SELECT (SELECT CASE WHEN sum(n) = 0 THEN 'passed' ELSE 'failed' END FROM entries) AS status, * FROM (
            FROM entries UNION ALL SELECT 'final_rows', final_rows FROM checks
            UNION ALL SELECT 'source_rows.' || source, rows FROM ({GOLDEN_SQL["source_row_counts"]})
        )
    """,
}
