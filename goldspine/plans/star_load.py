"""Normalise golden records into region, subregion, country and yearly indicators."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldspine import schema as S
from goldspine.functions.numbers import nan_to_null
from goldspine.functions.text import is_code
from goldspine.operators.aggregates import duplicate_count
from goldspine.operators.quality import country_rules, indicator_rules, violations
from goldspine.operators.upsert import CHANGE, assign_ids, new_keys, resolve_ids, upsert
from goldspine.plans.star_store import IDS, StarStore, timestamp_literal
from goldspine.sinks.staging import stage
from goldspine.sources.files import combined_fingerprint, fingerprints
from goldspine.sources.manifest import newest_output

# Columns a golden record must have and the year stamped by default.
MANDATORY = ("iso2", "iso3", "country_name", "source_count", "sources", "processed_at")
DEFAULT_YEAR = 2024


class InvalidLoad(ValueError):
    """The consolidated table or the result of the load breaks a constraint."""


def validate_golden(df: DataFrame) -> int:
    """Check the input in one aggregate; returns its row count."""
    S.require_columns(df, MANDATORY, "consolidated table")
    found = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in MANDATORY],
        F.count_if(~is_code(F.col("iso2"), 2)).alias("bad_iso2"),
        F.count_if(~is_code(F.col("iso3"), 3)).alias("bad_iso3"),
        duplicate_count("iso2").alias("dup_iso2"),
        duplicate_count("iso3").alias("dup_iso3"),
    ).first()
    if found["rows"] == 0:
        raise InvalidLoad("the consolidated table is empty")
    if any(found[f"null_{c}"] for c in MANDATORY):
        raise InvalidLoad("mandatory values are missing")
    for code in ("iso2", "iso3"):
        if found[f"bad_{code}"]:
            raise InvalidLoad(f"at least one {code.upper()} code is invalid")
        if found[f"dup_{code}"]:
            raise InvalidLoad(f"duplicate {code.upper()} codes")
    return found["rows"]


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def region_names(golden: DataFrame) -> DataFrame:
    """Distinct region names; a null or empty name gives no row."""
    return golden.where(_filled("region")).select(F.col("region").alias("region_name")).distinct()


def subregion_names(golden: DataFrame) -> DataFrame:
    """Distinct (region, subregion) names; a subregion needs its region."""
    rows = golden.where(_filled("region") & _filled("subregion"))
    return rows.select(F.col("region").alias("region_name"), F.col("subregion").alias("subregion_name")).distinct()


def new_members(existing: DataFrame, wanted: DataFrame, keys: list[str], id_column: str, now: Column) -> DataFrame:
    """Rows for the natural keys that ``existing`` lacks, with the next ids."""
    start = existing.agg(F.max(id_column)).first()[0] or 0
    added = assign_ids(new_keys(wanted, existing, keys), id_column, start)
    return added.withColumn("created_at", now).select(*existing.columns)


def extend_dimension(existing: DataFrame, wanted: DataFrame, keys: list[str], id_column: str, now: Column) -> DataFrame:
    """``existing`` plus the natural keys it lacks; ids of known keys never change."""
    return existing.unionByName(new_members(existing, wanted, keys, id_column, now))


def country_rows(golden: DataFrame, region: DataFrame, subregion: DataFrame) -> DataFrame:
    """Golden records with region and subregion replaced by ids."""
    golden = S.align(golden, S.CONSOLIDATED)
    keyed = golden.withColumns(
        {"region_name": F.nullif("region", F.lit("")), "subregion_name": F.nullif("subregion", F.lit(""))}
    )
    keyed = resolve_ids(keyed, region, ["region_name"], "region_id")
    return resolve_ids(keyed, subregion, ["region_id", "subregion_name"], "subregion_id")


def upsert_with_ids(
    target: DataFrame, incoming: DataFrame, keys: list[str], id_column: str, now: Column
) -> tuple[DataFrame, int]:
    """(target after the upsert, highest id before it); rows that are new get the next ids."""
    start = target.agg(F.max(id_column)).first()[0] or 0
    numbered = assign_ids(new_keys(incoming, target, keys), "_new_id", start)
    incoming = incoming.join(numbered, keys, "left").withColumn("loaded_at", now)
    columns = [c for c in target.columns if c not in (id_column, *keys)] + ["_new_id"]
    merged = upsert(target, incoming, keys, columns, on_insert={id_column: F.col("_new._new_id")})
    return merged.drop(CHANGE), start


def indicator_rows(golden: DataFrame, country: DataFrame, year: int) -> DataFrame:
    """Facts of the countries that have at least one measure, in the stored precision."""
    measured = S.align(golden, S.CONSOLIDATED).where(
        F.coalesce(F.col("population").cast("double"), nan_to_null(F.col("area_km2")), nan_to_null(F.col("gdp_usd"))).isNotNull()
    )
    joined = measured.join(country.select("iso3", "country_id"), "iso3")
    decimals = {"area_km2": (14, 2), "gdp_usd": (22, 2), "density_per_km2": (14, 2), "gdp_per_capita_usd": (18, 2)}
    return joined.select(
        "country_id",
        F.lit(year).alias("indicator_year"),
        "population",
        # An overflowing value fails the cast and with it the load.
        *[nan_to_null(F.col(c)).cast(f"decimal({p},{s})").alias(c) for c, (p, s) in decimals.items()],
    )


def _require_none(df: DataFrame, rules, table: str) -> None:
    broken = [row.asDict() for row in violations(df, rules).where("violations > 0").collect()]
    if broken:
        raise InvalidLoad(f"{table}: {broken}")


def load(spark: SparkSession, store: StarStore, source: str, year: int = DEFAULT_YEAR) -> dict[str, Any]:
    """Load one consolidated Parquet output; all tables change together or not at all.

    Re-running a load gives the same tables. Counters are read from the
    written versions, so a retried task cannot count twice.
    """
    golden = spark.read.parquet(source)
    rows_read = validate_golden(golden)
    digest = fingerprints(spark, source).agg(*combined_fingerprint(source)).first()["sha256"]
    row = store.begin(source, digest, rows_read)
    load_id, stamp = row["load_id"], row["started_at"]
    now = timestamp_literal(stamp)
    try:
        base, versions = store.head()

        def write(name: str, df: DataFrame, replaces: set[int]) -> DataFrame:
            versions[name] = store.write_version(name, df, load_id, versions, replaces)
            return store.table(name, versions)

        region = write("region", new_members(store.table("region", versions), region_names(golden), ["region_name"], "region_id", now), set())
        named = resolve_ids(subregion_names(golden), region, ["region_name"], "region_id")
        subregion = write(
            "subregion",
            new_members(
                store.table("subregion", versions), named.select("region_id", "subregion_name"),
                ["region_id", "subregion_name"], "subregion_id", now,
            ), set(),
        )

        def merge(name: str, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
            """Rows that meet a stored one take the place of its bucket; new ones are added to it, or to none."""
            stored, rows = store.table(name, versions), stage(rows, f"{name}-rows")
            touched = store.touched(name, stored.join(rows.select(*keys), keys, "left_semi"))
            merged, last = upsert_with_ids(stored, rows, keys, IDS[name], now)
            fresh = F.col(IDS[name]) > last
            return write(name, merged.where(fresh | store.bucket(name).isin(touched)), touched), last

        country, last_country = merge("country", country_rows(golden, region, subregion), ["iso3"])
        _require_none(country, country_rules(), "country")
        if country.agg(duplicate_count("iso2")).first()[0]:
            raise InvalidLoad("country: an ISO2 code belongs to two countries")
        indicator, _ = merge("country_indicator", indicator_rows(golden, country, year), ["country_id", "indicator_year"])
        _require_none(indicator, indicator_rules(), "country_indicator")
        counters = _counters(country, indicator, now, last_country)
        store.commit(row, base, versions, **counters)
    except Exception as error:
        store.fail(row, error)
        raise
    return {"load_id": load_id, "source_sha256": digest, "rows_read": rows_read, **counters}


def _counters(country: DataFrame, indicator: DataFrame, now: Column, last_country: int) -> dict[str, int]:
    touched = F.col("loaded_at") == now
    counted = country.agg(
        F.count_if(F.col("country_id") > last_country).alias("countries_inserted"),
        F.count_if(touched & (F.col("country_id") <= last_country)).alias("countries_updated"),
    ).first()
    facts = indicator.agg(F.count_if(touched).alias("indicators_upserted")).first()
    return {**counted.asDict(), **facts.asDict()}


def load_latest(spark: SparkSession, store: StarStore, root: str, year: int = DEFAULT_YEAR) -> dict[str, Any]:
    """Load the newest consolidated table below ``root``."""
    newest = newest_output(spark, f"{root}/data/processed", "countries_consolidated_*.parquet")
    return load(spark, store, newest, year)
