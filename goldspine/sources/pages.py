"""Captured pages of a paged JSON interface and the records they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from goldspine.functions import variants as V
from goldspine.sinks.staging import stage

MAX_PAGE = 100

# Where each field sits in the known layouts, in order of preference.
PATHS = {
    "iso2": [("codes", "alpha_2"), ("cca2",), ("alpha2Code",)],
    "iso3": [("codes", "alpha_3"), ("cca3",), ("alpha3Code",)],
    "country_name": [("names", "common"), ("name", "common"), ("name",)],
    "official_name": [("names", "official"), ("name", "official")],
    "capital": [("capital", "name"), ("capital",), ("capitals",)],
    "region": [("geography", "region"), ("region",)],
    "subregion": [("geography", "subregion"), ("subregion",)],
    "population": [("demographics", "population"), ("population",)],
    "area_km2": [("geography", "area"), ("area",)],
}


class PageError(ValueError):
    """A captured payload breaks the paging protocol."""


def check_page_size(page_size: int) -> int:
    if not 1 <= page_size <= MAX_PAGE:
        raise ValueError(f"page_size must be in 1..{MAX_PAGE}")
    return page_size


def parse_pages(captured: DataFrame, payload: str, offset: str | None = None) -> DataFrame:
    """Add the parsed page, its number of objects and ``problem`` (null if sound).

    Unparsable text is a problem of its row, never a failed job.
    """
    value = F.col("_page")
    parsed = captured.withColumn("_page", F.try_parse_json(F.col(payload)))
    objects, more = V.at(value, ("data", "objects")), V.at(value, ("data", "meta", "more"))
    count = F.coalesce(F.size(F.try_variant_get(objects, "$", "array<variant>")), F.lit(0))
    more_flag = F.try_variant_get(more, "$", "boolean")
    problem = (
        F.when(value.isNull(), "not JSON")
        .when(~V.is_object(value), "payload is not an object")
        .when(F.coalesce(F.try_variant_get(value, "$.success", "boolean") == F.lit(False), F.lit(False)), "interface reported failure")
        .when(~V.is_object(V.at(value, ("data",))), "data is missing")
        .when(~V.is_array(objects) | ~V.is_object(V.at(value, ("data", "meta"))), "objects or meta is missing")
        .when(~V.is_boolean(more), "more is not a boolean")
        .when(more_flag & (count == 0), "empty page announces more")
    )
    return parsed.select("*", count.cast("bigint").alias("_count"), more_flag.alias("_more"), problem.alias("problem"))


def protocol_summary(parsed: DataFrame, offset: str) -> DataFrame:
    """One row: is the capture complete? (pages, objects, problems, terminal pages, gaps).

    The pages chain if each non-terminal page's end is another page's offset,
    which is a join of offsets and needs no global order. Four narrow columns
    are staged, so the payloads are parsed once.
    """
    parsed = stage(parsed.select(offset, "_count", "_more", "problem"), "pages")
    ends = parsed.where(F.col("_more")).select((F.col(offset) + F.col("_count")).alias("_next"))
    starts = parsed.select(F.col(offset).alias("_next")).distinct()
    gaps = ends.join(starts, "_next", "left_anti").agg(F.count("*").alias("gaps"))
    totals = parsed.agg(
        F.count("*").alias("pages"),
        F.coalesce(F.sum("_count"), F.lit(0)).alias("objects"),
        F.count_if(F.col("problem").isNotNull()).alias("problems"),
        F.count_if(F.col("_more") == F.lit(False)).alias("terminal_pages"),
        F.min(offset).alias("first_offset"),
        F.max(F.col(offset) + F.col("_count")).alias("end_offset"),
    )
    complete = (
        (F.col("problems") == 0)
        & (F.col("terminal_pages") == 1)
        & (F.col("first_offset") == 0)
        & (F.col("end_offset") == F.col("objects"))
        & (F.col("gaps") == 0)
    )
    return totals.withColumn("gaps", gaps.scalar()).withColumn("complete", F.coalesce(complete, F.lit(False)))


def explode_objects(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per object of the sound pages, with its position in the page.

    Unsound pages explode to nothing. A filter on ``problem`` would be pushed
    below the parsing and repeat it for every test.
    """
    entries = F.try_variant_get(F.col("_page"), "$.data.objects", "array<variant>")
    sound = F.when(F.col("problem").isNull(), entries)
    rows = parsed.select(*keep, F.posexplode_outer(sound).alias("position", "item"))
    return rows.where(F.col("position").isNotNull())


def normalize_records(objects: DataFrame, *keep: str, source_url: str | None = None, item: str = "item") -> DataFrame:
    """Flat records from nested objects of any known layout; other items are skipped.

    Each step is a projection of its own over the columns of the one before:
    the value at every path, then the first that is present, then its kind, then
    the field. So a path is looked up once, however often its value is asked for.
    """
    value = F.col(item)
    at = objects.where(V.is_object(value)).select(
        *keep,
        *[V.at(value, path).alias(f"_{field}_{k}") for field, paths in PATHS.items() for k, path in enumerate(paths)],
        V.at(value, ("currencies",)).alias("_currencies"), V.at(value, ("languages",)).alias("_languages"),
    )
    lists = ("currencies", "languages")
    first = at.select(
        *keep, *[V.first_of([F.col(f"_{field}_{k}") for k in range(len(paths))]).alias(field) for field, paths in PATHS.items()],
        *[F.col(f"_{c}").alias(c) for c in lists],
    )
    # Unwrapped: the first capital of a list, the square kilometres of an area.
    unwrapped = first.select(
        *keep, *[c for c in (*PATHS, *lists) if c not in ("capital", "area_km2")],
        V.first_item(F.col("capital")).alias("capital"), V.measure(F.col("area_km2"), "kilometers").alias("area_km2"),
    )
    named = unwrapped.withColumn("capital", V.named(F.col("capital"), "name"))
    kinds = named.select("*", *[V.kind(F.col(field)).alias(f"_kind_{field}") for field in PATHS])

    def text(field: str) -> Column:
        return V.text_of(F.col(field), F.col(f"_kind_{field}")).alias(field)

    return kinds.select(
        *keep,
        text("iso2"),
        text("iso3"),
        text("country_name"),
        text("official_name"),
        text("capital"),
        text("region"),
        text("subregion"),
        V.integer(F.col("population"), F.col("_kind_population")).alias("population"),
        V.double(F.col("area_km2"), F.col("_kind_area_km2")).alias("area_km2"),
        V.labels(F.col("currencies"), "code").alias("currencies"),
        V.labels(F.col("languages"), "name").alias("languages"),
        F.lit("api").alias("source_type"),
        F.lit(source_url).cast("string").alias("source_url"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("extracted_at"),
    )


def extract_records(captured: DataFrame, payload: str, offset: str, source_url: str | None = None) -> DataFrame:
    """The whole ingest with its blocking checks: protocol, then at least one record."""
    parsed = parse_pages(captured, payload)
    summary = protocol_summary(parsed, offset).first()
    if not summary["complete"]:
        raise PageError(f"incomplete capture: {summary.asDict()}")
    records = normalize_records(explode_objects(parsed), source_url=source_url)
    if records.isEmpty():
        raise PageError("the pages hold no record")
    return records
