"""Checks on the published tables after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldspine.operators.access import most_recent
from goldspine.operators.aggregates import key_summary
from goldspine.operators.joins import orphans
from goldspine.operators.quality import Rule, YEAR_RANGE, any_broken


def value_rules(year: str = "indicator_year") -> list[Rule]:
    return [
        Rule("population < 0", F.col("population") < 0),
        Rule("area_km2 <= 0", F.col("area_km2") <= 0),
        Rule("gdp_usd < 0", F.col("gdp_usd") < 0),
        Rule(f"{year} out of range", ~F.col(year).between(*YEAR_RANGE)),
    ]


def post_load_checks(
    region: DataFrame, subregion: DataFrame, country: DataFrame, indicator: DataFrame, audit: DataFrame
) -> dict[str, DataFrame]:
    """The five checks; the orphan and value checks must come back empty."""
    return {
        "keys": key_summary(country, ["iso2", "iso3"]),
        "orphan_region": orphans(country, region, "region_id", "region_id").select("iso3", "region_id"),
        "orphan_subregion": orphans(country, subregion, "subregion_id", "subregion_id").select("iso3", "subregion_id"),
        "orphan_indicator": orphans(indicator, country, "country_id", "country_id").select(
            "country_indicator_id", "country_id"
        ),
        "bad_values": indicator.where(any_broken(value_rules())),
        "last_load": most_recent(audit, "started_at", 1, tie_break=("load_id",)),
    }
