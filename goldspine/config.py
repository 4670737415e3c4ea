"""What to consolidate: columns, priorities, aliases, quality rules. Data, not code."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from goldspine import schema as S
from goldspine.operators.quality import QualityConfig


@dataclass(frozen=True)
class Ratio:
    """A derived measure: numerator / denominator, half-up."""

    name: str
    numerator: str
    denominator: str
    places: int = 2


@dataclass(frozen=True)
class Consolidation:
    spine: str
    key: str
    name: str
    name_key: str
    spine_columns: tuple[str, ...]
    canonical: str
    priority: Mapping[str, tuple[str, ...]]
    quality: QualityConfig
    aliases: Mapping[str, str] = field(default_factory=dict)
    ratios: tuple[Ratio, ...] = ()


# Survivorship order, aliases and thresholds of the country data set.
COUNTRIES = Consolidation(
    spine="file",
    key="iso3",
    name="country_name",
    name_key="country_key",
    spine_columns=("iso2", "country_name"),
    canonical=S.CONSOLIDATED,
    priority={
        "country_name": ("file", "api", "database", "bigdata", "scraping"),
        "official_name": ("api",),
        "capital": ("api",),
        "region": ("database", "api"),
        "subregion": ("database", "api"),
        "population": ("bigdata", "scraping", "api"),
        "area_km2": ("bigdata", "api"),
        "gdp_usd": ("bigdata",),
        "currencies": ("api",),
        "languages": ("api",),
    },
    aliases={
        "czechia": "czech republic",
        "turkiye": "turkey",
        "russian federation": "russia",
        "united states of america": "united states",
        "viet nam": "vietnam",
        "republic of korea": "south korea",
        "democratic republic of the congo": "dr congo",
        "congo democratic republic": "dr congo",
    },
    quality=QualityConfig(
        mandatory=("iso2", "iso3", "country_name"),
        unique=("iso2", "iso3"),
        code_lengths={"iso2": 2, "iso3": 3},
        non_negative=("population",),
        positive=("area_km2",),
        minimum_sources=1,
    ),
    ratios=(
        Ratio("density_per_km2", "population", "area_km2"),
        Ratio("gdp_per_capita_usd", "gdp_usd", "population"),
    ),
)
# Names of two checks in the report document.
REPORT_NAMES = {"negative_population": "negative_population", "non_positive_area_km2": "non_positive_area"}
# The files of each source.
RAW_PATTERNS = {
    "file": "countries_iso_*",
    "api": "countries_api_*",
    "scraping": "countries_scraping_*",
    "database": "countries_database_*",
    "bigdata": "country_indicators_*",
}
