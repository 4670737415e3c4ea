"""The five country sources as raw outputs with a run manifest."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldspine import schema as S
from goldspine.functions.text import is_blank, is_code
from goldspine.operators.aggregates import duplicate_count
from goldspine.operators.ranking import top_k_by_measure
from goldspine.sinks.documents import slug, write_table
from goldspine.sources.files import read_csv, read_parquet, write_raw
from goldspine.sources.html import require_records, scraped_records
from goldspine.sources.manifest import run_sources
from goldspine.sources.pages import extract_records
from goldspine.sources.tables import scan_active


class InvalidSource(ValueError):
    """A source's content breaks its contract."""


def validate_code_file(df: DataFrame) -> DataFrame:
    """Non-empty; no blank cell; capital-letter codes of the right length; unique codes."""
    columns = S.schema(S.CODE_FILE).fieldNames()
    S.require_columns(df, columns, "code file")
    lengths = {"iso2": 2, "iso3": 3}
    found = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_blank(F.col(c))).alias(f"blank_{c}") for c in columns],
        *[F.count_if(~is_code(F.col(c), n)).alias(f"invalid_{c}") for c, n in lengths.items()],
        *[duplicate_count(c).alias(f"duplicate_{c}") for c in lengths],
    ).first()
    if found["rows"] == 0:
        raise InvalidSource("the code file is empty")
    for column in columns:
        if found[f"blank_{column}"]:
            raise InvalidSource(f"missing values in {column}")
    for column in lengths:
        if found[f"invalid_{column}"]:
            raise InvalidSource(f"invalid codes in {column}: capital letters expected")
        if found[f"duplicate_{column}"]:
            raise InvalidSource(f"duplicate codes in {column}")
    return df


def top_indicators(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of the indicator table that have a code and a population; with a limit, the most populous."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    columns = S.schema(S.INDICATOR_FILE).fieldNames()
    rows = S.require_columns(df, columns, "indicators").select(*columns)
    rows = rows.where(F.col("iso3").isNotNull() & F.col("population").isNotNull())
    return rows if limit is None else top_k_by_measure(rows, "population", ("iso3", "year"), limit)


def _write(spark: SparkSession, df: DataFrame, root: str, output: str, file_format: str, **options: str) -> tuple[str, int]:
    write_table(df, f"{root}/{output}", file_format, **options)
    reader = spark.read.option("header", True) if file_format == "csv" else spark.read
    written = reader.format(file_format).load(f"{root}/{output}")
    rows = written.count()
    if rows == 0:
        raise InvalidSource(f"no valid row for {output}")
    return output, rows


def file_job(spark: SparkSession, path: str, root: str, raw: str = "data/raw") -> Callable[[], tuple[str, int]]:
    def job():
        df = validate_code_file(read_csv(spark, path, S.CODE_FILE))
        write_raw(spark, path, f"{root}/{raw}/copies/file_{slug()}")
        return _write(spark, df, root, f"{raw}/file/countries_iso_{slug()}", "csv")

    return job


def database_job(spark: SparkSession, table: DataFrame, root: str, raw: str = "data/raw") -> Callable[[], tuple[str, int]]:
    def job():
        df = scan_active(table, "iso2").select("iso2", "iso3", "country_name", "region_name", "subregion_name")
        return _write(spark, df, root, f"{raw}/database/countries_database_{slug()}", "parquet")

    return job


def bigdata_job(spark: SparkSession, path: str, root: str, raw: str = "data/raw", limit: int | None = None) -> Callable[[], tuple[str, int]]:
    def job():
        df = top_indicators(read_parquet(spark, path), limit)
        output = f"{raw}/bigdata/country_indicators_{slug()}"
        return _write(spark, df, root, output, "parquet", compression="zstd")

    return job


def api_job(spark: SparkSession, captured: DataFrame, payload: str, offset: str, url: str, root: str, raw: str = "data/raw") -> Callable[[], tuple[str, int]]:
    def job():
        df = extract_records(captured, payload, offset, url)
        return _write(spark, df, root, f"{raw}/api/countries_api_{slug()}", "json")

    return job


def scraping_job(spark: SparkSession, pages: DataFrame, html: str, url: str, root: str, raw: str = "data/raw", table_id: str | None = None) -> Callable[[], tuple[str, int]]:
    def job():
        df = require_records(scraped_records(pages, html, url, table_id))
        # The pages as they came.
        pages.select(url, html).write.parquet(f"{root}/{raw}/copies/scraping_{slug()}")
        return _write(spark, df, root, f"{raw}/scraping/countries_scraping_{slug()}", "json")

    return job


def extract(spark: SparkSession, jobs: Mapping[str, Callable[[], tuple[str, int]]], root: str, raw: str = "data/raw", continue_on_error: bool = False) -> str:
    """Run the chosen sources; returns the path of the run manifest."""
    return run_sources(spark, jobs, root, raw, continue_on_error)
