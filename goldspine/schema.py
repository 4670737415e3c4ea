"""Table schemas and the helpers that bring a frame into one of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


# Column names, order and types of the published tables.
CODE_FILE = "iso2 string, iso3 string, country_name string"
INDICATOR_FILE = (
    "iso3 string, country_name string, year int, population bigint, area_km2 double, gdp_usd double"
)
API_RECORD = (
    "iso2 string, iso3 string, country_name string, official_name string, capital string, "
    "region string, subregion string, population bigint, area_km2 double, "
    "currencies array<string>, languages array<string>, "
    "source_type string, source_url string, extracted_at string"
)
SCRAPED_RECORD = (
    "country_name string, population_scraped bigint, "
    "source_type string, source_url string, extracted_at string"
)
CONSOLIDATED = (
    "iso2 string, iso3 string, country_name string, official_name string, capital string, "
    "region string, subregion string, population bigint, area_km2 double, gdp_usd double, "
    "density_per_km2 double, gdp_per_capita_usd double, currencies string, languages string, "
    "source_count bigint, sources string, processed_at timestamp"
)
REGION = "region_id bigint, region_name string, created_at timestamp"
SUBREGION = "subregion_id bigint, region_id bigint, subregion_name string, created_at timestamp"
COUNTRY = (
    "country_id bigint, region_id bigint, subregion_id bigint, iso2 string, iso3 string, "
    "country_name string, official_name string, capital string, currencies string, "
    "languages string, source_count smallint, sources string, processed_at timestamp, "
    "loaded_at timestamp"
)
INDICATOR = (
    "country_indicator_id bigint, country_id bigint, indicator_year int, population bigint, "
    "area_km2 decimal(14,2), gdp_usd decimal(22,2), density_per_km2 decimal(14,2), "
    "gdp_per_capita_usd decimal(18,2), loaded_at timestamp"
)
AUDIT = (
    "load_id string, source_file string, source_sha256 string, started_at timestamp, "
    "completed_at timestamp, status string, rows_read int, countries_inserted int, "
    "countries_updated int, indicators_upserted int, error_message string"
)
STAR_TABLES = {
    "region": REGION,
    "subregion": SUBREGION,
    "country": COUNTRY,
    "country_indicator": INDICATOR,
}


class MissingColumns(ValueError):
    """A frame lacks columns its role requires."""


def require_columns(df: DataFrame, required: Iterable[str], role: str = "frame") -> DataFrame:
    """Fail on absent columns, naming them sorted; reads only the schema."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumns(f"{role}: missing columns {missing}")
    return df


def align(df: DataFrame, target: T.StructType | str, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Project onto ``target``: fixed order and types, absent columns null.

    ``defaults`` fills a column where it is absent or null.
    """
    fields = schema(target).fields if isinstance(target, str) else target.fields
    present = set(df.columns)
    defaults = defaults or {}

    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`") if field.name in present else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name].cast(field.dataType))
        return value.alias(field.name)

    return df.select(*[column(field) for field in fields])


def describe(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions; Parquet keeps them with the table."""
    return df.select(
        *[
            F.col(name).alias(name, metadata={"comment": comments[name]}) if name in comments else F.col(name)
            for name in df.columns
        ]
    )
