"""Bring each source into comparable columns: codes, name key, numbers, one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from goldspine import schema as S
from goldspine.functions.collections import serialize
from goldspine.functions.numbers import to_double, to_integer
from goldspine.functions.text import apply_aliases, clean_code, normalize_name
from goldspine.operators.dedupe import highest_per_key
from goldspine.sources.files import ORDINAL


@dataclass(frozen=True)
class Standard:
    """How one source is cleaned. Column lists name columns after the renames."""

    source: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    codes: Mapping[str, int] = field(default_factory=dict)
    name: str = "country_name"
    name_key: str = "country_key"
    integers: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    collections: tuple[str, ...] = ()
    period: str | None = None
    drop_null_key: bool = False


def standardize(
    df: DataFrame, spec: Standard, aliases: Mapping[str, str], ordinal: Sequence[str] = (ORDINAL,)
) -> DataFrame:
    """Clean ``df`` and keep the last row of each key (of its latest period, if any).

    Only the key is cleaned before the rows are reduced to one per key; names,
    numbers and collections are cleaned on the rows that remain. ``ordinal``
    columns give the input order. Without them the order is that of the scan,
    which only holds for a frame read directly from files.
    """
    S.require_columns(df, spec.required, f"source {spec.source}")
    ordinal = [name for name in ordinal if name in df.columns]
    if not ordinal:
        df, ordinal = df.withColumn(ORDINAL, F.monotonically_increasing_id()), [ORDINAL]
    renames = {old: new for old, new in spec.renames.items() if old in df.columns}
    df = df.drop(*[new for old, new in renames.items() if new in df.columns]).withColumnsRenamed(renames)
    present = set(df.columns)
    places = [f"_o{i}" for i in range(len(ordinal))]

    def absent(name: str) -> Column:
        kind = "bigint" if name in spec.integers else "double" if name in spec.doubles else "string"
        return F.lit(None).cast(kind).alias(name)

    def keyed(name: str) -> Column:
        value = F.col(f"`{name}`")
        return (clean_code(value, spec.codes[name]) if name in spec.codes else value).alias(name)

    by_name = spec.name_key in spec.key
    name_key = apply_aliases(normalize_name(F.col(f"`{spec.name}`").cast("string")), aliases).alias(spec.name_key)
    raw = df.select(
        *[keyed(name) if name in spec.key else F.col(f"`{name}`") for name in spec.columns if name in present],
        *([name_key] if by_name else []),
        *[F.col(f"`{name}`").alias(place) for name, place in zip(ordinal, places)],
    )
    order = [*([spec.period] if spec.period and spec.period in present else []), *places]
    last = highest_per_key(raw, list(spec.key), order)
    if spec.drop_null_key:
        last = last.dropna(subset=list(spec.key))
    types = {field.name: field.dataType for field in last.schema.fields}

    def cleaned(name: str) -> Column:
        if name not in present:
            return absent(name)
        value = F.col(f"`{name}`")
        if name in spec.codes and name not in spec.key:
            value = clean_code(value, spec.codes[name])
        elif name in spec.integers:
            value = to_integer(value, types[name])
        elif name in spec.doubles:
            value = to_double(value, types[name])
        elif name in spec.collections:
            value = serialize(value, types[name])
        return value.alias(name)

    if by_name:
        name_key = F.col(spec.name_key)
    elif spec.name not in present:
        name_key = F.lit(None).cast("string").alias(spec.name_key)
    return last.select(
        *[cleaned(name) for name in spec.columns], name_key, F.lit(spec.source).alias("source")
    )


# Columns of the five country sources.
FILE = Standard(
    source="file",
    columns=("iso2", "iso3", "country_name"),
    required=("iso2", "iso3", "country_name"),
    key=("iso3",),
    codes={"iso2": 2, "iso3": 3},
)
API = Standard(
    source="api",
    columns=(
        "iso2", "iso3", "country_name", "official_name", "capital", "region",
        "subregion", "population", "area_km2", "currencies", "languages",
    ),
    key=("iso3",),
    renames={"region_name": "region", "subregion_name": "subregion"},
    codes={"iso2": 2, "iso3": 3},
    integers=("population",),
    doubles=("area_km2",),
    collections=("currencies", "languages"),
)
SCRAPING = Standard(
    source="scraping",
    columns=("country_name", "population"),
    required=("country_name",),
    key=("country_key",),
    renames={"population_scraped": "population"},
    integers=("population",),
    drop_null_key=True,
)
DATABASE = Standard(
    source="database",
    columns=("iso2", "iso3", "country_name", "region", "subregion"),
    key=("iso3",),
    renames={"region_name": "region", "subregion_name": "subregion"},
    codes={"iso2": 2, "iso3": 3},
)
BIGDATA = Standard(
    source="bigdata",
    columns=("iso3", "country_name", "year", "population", "area_km2", "gdp_usd"),
    key=("iso3",),
    codes={"iso3": 3},
    integers=("population",),
    doubles=("area_km2", "gdp_usd"),
    period="year",
)
STANDARDS = {spec.source: spec for spec in (FILE, API, SCRAPING, DATABASE, BIGDATA)}


def standardize_scraping(df: DataFrame, aliases: Mapping[str, str], ordinal: Sequence[str] = (ORDINAL,)) -> DataFrame:
    """The scraped source, whose count has either of two names."""
    if not {"population_scraped", "population"} & set(df.columns):
        raise S.MissingColumns("source scraping: missing columns ['population']")
    return standardize(df, SCRAPING, aliases, ordinal)
