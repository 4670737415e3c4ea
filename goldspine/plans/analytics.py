"""Named, parameterised analytic queries and their plans."""

from __future__ import annotations

import io
from collections.abc import Callable, Mapping
from contextlib import redirect_stdout
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from goldspine.functions.numbers import frame_ratio
from goldspine.operators.aggregates import group_counts, group_statistics, group_totals
from goldspine.operators.dedupe import latest_per_key
from goldspine.operators.ranking import dense_rank_within
from goldspine.sinks.documents import slug, write_table


def countries_by_region(reference: DataFrame, minimum_country_count: int = 1) -> DataFrame:
    """Active countries per region holding at least that many."""
    return group_counts(reference, "region_name", minimum_country_count, F.col("active"))


def latest_indicators(
    reference: DataFrame,
    indicators: DataFrame,
    minimum_population: int = 1_000_000,
    key: str = "iso3",
    period: str = "year",
    tie_break: tuple[str, ...] = (),
    group: str = "region_name",
    name: str = "country_name",
) -> DataFrame:
    """Each active entity with its latest usable indicators, ratios and rank in its group.

    Only the latest row per key leaves a map task, so the fact table crosses
    the network once, reduced; both join sides then hold each key once.
    """
    usable = indicators.where(
        F.col("population").isNotNull() & F.col("area_km2").isNotNull() & (F.col("area_km2") > 0)
    )
    columns = dict.fromkeys((key, period, "population", "area_km2", "gdp_usd", *tie_break))
    latest = latest_per_key(usable.select(*columns), [key], period, tie_break)
    facts = latest.select(key, period, "population", "area_km2", "gdp_usd")
    entities = reference.where(F.col("active")).drop("active")
    joined = entities.join(facts, key).where(F.col("population") >= minimum_population)
    enriched = joined.withColumns(
        {
            "density_per_km2": frame_ratio(joined, "population", "area_km2"),
            "gdp_per_capita_usd": frame_ratio(joined, "gdp_usd", "population"),
        }
    )
    ranked = dense_rank_within(enriched, group, "population", "population_rank_in_region")
    return ranked.orderBy(F.col(group).asc_nulls_last(), "population_rank_in_region", F.col(name).asc_nulls_last())


def region_statistics(
    reference: DataFrame,
    indicators: DataFrame,
    indicator_year: int = 2024,
    minimum_total_population: int = 1_000_000,
    key: str = "iso3",
    period: str = "year",
    group: str = "region_name",
) -> DataFrame:
    """Totals, mean and weighted ratio per region for one year.

    Facts are added up per key before the join, so a key holding a third of
    the facts is one row when it meets its entity.
    """
    facts = indicators.where(F.col(period) == indicator_year)
    totals = group_totals(facts, [key], "population", "gdp_usd")
    entities = reference.where(F.col("active")).select(key, group)
    return group_statistics(entities.join(totals, key), group, minimum_total_population)


@dataclass(frozen=True)
class NamedQuery:
    build: Callable[..., DataFrame]
    tables: tuple[str, ...]
    defaults: Mapping[str, Any]


# Names and default parameters of the standard queries.
CATALOGUE = {
    "regions": NamedQuery(countries_by_region, ("country_reference",), {"minimum_country_count": 1}),
    "indicators": NamedQuery(
        latest_indicators, ("country_reference", "country_indicators"), {"minimum_population": 1_000_000}
    ),
    "statistics": NamedQuery(
        region_statistics,
        ("country_reference", "country_indicators"),
        {"indicator_year": 2024, "minimum_total_population": 1_000_000},
    ),
}


def run_query(spark: SparkSession, name: str, **params: Any) -> DataFrame:
    """A catalogue query over the session's tables of the usual names."""
    query = CATALOGUE[name]
    unknown = set(params) - set(query.defaults)
    if unknown:
        raise ValueError(f"query {name} has no parameter {sorted(unknown)}")
    return query.build(*[spark.table(t) for t in query.tables], **{**query.defaults, **params})


def export_queries(spark: SparkSession, folder: str, names: tuple[str, ...] = tuple(CATALOGUE), explain: bool = True) -> dict[str, str]:
    """Run and export queries as CSV, and the plan of the ranking query as text."""
    stamp = slug()
    outputs = {n: write_table(run_query(spark, n), f"{folder}/{n}_{stamp}", "csv") for n in names}
    if explain:
        plan = plan_lines(spark, run_query(spark, "indicators"), execute=True)
        outputs["explain"] = write_table(plan.orderBy("line").select("text"), f"{folder}/explain_{stamp}", "text")
    return outputs


def plan_lines(spark: SparkSession, df: DataFrame, execute: bool = False) -> DataFrame:
    """The formatted plan of ``df``, one row per line.

    With ``execute`` the query runs in full first, its rows discarded, and
    their number ends the text.
    """
    lines = _explain(df).splitlines()
    if execute:
        seen = Observation("plan_lines")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        lines.append(f"rows: {seen.get['rows']}")
    return spark.createDataFrame(list(enumerate(lines)), "line bigint, text string")


def _explain(df: DataFrame) -> str:
    buffer = io.StringIO()
    with redirect_stdout(buffer):
        df.explain("formatted")
    return buffer.getvalue()
