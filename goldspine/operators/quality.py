"""Rules on rows, counts of their violations, and the pass/fail report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldspine.functions.text import is_blank, is_code
from goldspine.operators.aggregates import duplicate_count


@dataclass(frozen=True)
class Rule:
    """``broken`` is true on a bad row; null means the row passes."""

    name: str
    broken: Column

    def fails(self) -> Column:
        return F.coalesce(self.broken, F.lit(False))


def not_null(column: str) -> Rule:
    return Rule(f"{column} is null", F.col(column).isNull())


def not_blank(column: str) -> Rule:
    return Rule(f"{column} is blank", is_blank(F.col(column)))


def code_format(column: str, length: int) -> Rule:
    return Rule(f"{column} is not {length} capital letters", ~is_code(F.col(column), length))


def between(column: str, low, high) -> Rule:
    return Rule(f"{column} outside {low}..{high}", ~F.col(column).between(low, high))


def at_least(column: str, low) -> Rule:
    return Rule(f"{column} below {low}", F.col(column) < low)


def above(column: str, low) -> Rule:
    return Rule(f"{column} not above {low}", F.col(column) <= low)


def one_of(column: str, values: Sequence[str]) -> Rule:
    return Rule(f"{column} not in {'/'.join(values)}", ~F.col(column).isin(*values))


def length_between(column: str, low: int, high: int) -> Rule:
    return Rule(f"{column} length outside {low}..{high}", ~F.length(F.col(column)).between(low, high))


def fits(column: str, precision: int, scale: int) -> Rule:
    """A value that overflows the decimal type (rounding to scale is allowed)."""
    value = F.col(column)
    return Rule(
        f"{column} exceeds decimal({precision},{scale})",
        value.isNotNull() & value.try_cast(f"decimal({precision},{scale})").isNull(),
    )


# Limits of the published tables.
YEAR_RANGE = (1900, 2100)
LOAD_STATES = ("started", "success", "failed")


def indicator_rules() -> list[Rule]:
    return [
        not_null("country_id"),
        above("country_id", 0),
        not_null("indicator_year"),
        between("indicator_year", *YEAR_RANGE),
        at_least("population", 0),
        above("area_km2", 0),
        at_least("gdp_usd", 0),
        at_least("density_per_km2", 0),
        at_least("gdp_per_capita_usd", 0),
        fits("area_km2", 14, 2),
        fits("gdp_usd", 22, 2),
        fits("density_per_km2", 14, 2),
        fits("gdp_per_capita_usd", 18, 2),
    ]


def country_rules() -> list[Rule]:
    return [
        *[not_null(c) for c in ("iso2", "iso3", "country_name", "source_count", "sources", "processed_at")],
        code_format("iso2", 2),
        code_format("iso3", 3),
        length_between("country_name", 1, 150),
        length_between("official_name", 0, 200),
        length_between("capital", 0, 150),
        at_least("source_count", 1),
        Rule("sources length below 1", F.length("sources") < 1),
        above("region_id", 0),
        above("subregion_id", 0),
    ]


def region_rules() -> list[Rule]:
    return [not_null("region_name"), length_between("region_name", 1, 100)]


def subregion_rules() -> list[Rule]:
    return [
        not_null("region_id"),
        above("region_id", 0),
        not_null("subregion_name"),
        length_between("subregion_name", 1, 100),
    ]


def audit_rules() -> list[Rule]:
    return [
        not_null("load_id"),
        length_between("source_file", 1, 500),
        one_of("status", LOAD_STATES),
        *[at_least(c, 0) for c in ("rows_read", "countries_inserted", "countries_updated", "indicators_upserted")],
    ]


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations) for every rule, from one pass over ``df``."""
    counts = df.agg(*[F.count_if(rule.fails()).alias(f"r{i}") for i, rule in enumerate(rules)])
    pairs = F.array(
        *[
            F.struct(F.lit(rule.name).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(pairs))


def with_reasons(df: DataFrame, rules: Sequence[Rule], column: str = "reason") -> DataFrame:
    """Add the names of the broken rules joined by ``; ``, null on a good row."""
    broken = F.concat_ws("; ", *[F.when(rule.fails(), F.lit(rule.name)) for rule in rules])
    return df.withColumn(column, F.nullif(broken, F.lit("")))


def any_broken(rules: Sequence[Rule]) -> Column:
    return reduce(lambda left, right: left | right, [rule.fails() for rule in rules])


@dataclass(frozen=True)
class QualityConfig:
    mandatory: tuple[str, ...]
    unique: tuple[str, ...]
    code_lengths: Mapping[str, int]
    non_negative: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    source_count: str = "source_count"
    minimum_sources: int = 1


def quality_checks(df: DataFrame, config: QualityConfig) -> DataFrame:
    """One row of counts, from a single aggregate over ``df``."""
    measures: dict[str, Column] = {}
    for name in config.mandatory:
        measures[f"null_{name}"] = F.count_if(F.col(name).isNull())
    for name in config.unique:
        measures[f"duplicate_{name}"] = duplicate_count(name)
    for name, length in config.code_lengths.items():
        measures[f"invalid_{name}"] = F.count_if(
            F.coalesce(F.length(F.col(name).cast("string")) != length, F.lit(True))
        )
    for name in config.non_negative:
        measures[f"negative_{name}"] = F.count_if(F.col(name) < 0)
    for name in config.positive:
        measures[f"non_positive_{name}"] = F.count_if(F.col(name) <= 0)
    measures["rows_below_minimum_sources"] = F.count_if(F.col(config.source_count) < config.minimum_sources)
    return df.agg(F.count("*").alias("final_rows"), *[m.alias(n) for n, m in measures.items()])


def quality_report(
    df: DataFrame,
    config: QualityConfig,
    sources: Mapping[str, DataFrame] | None = None,
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """The report document: status, time, row counts per source and the checks.

    ``renames`` maps a check to the name it has in the document.
    """
    renames = renames or {}
    checks = quality_checks(df, config)
    names = [name for name in checks.columns if name != "final_rows"]
    passed = reduce(lambda left, right: left & right, [F.col(name) == 0 for name in names])

    def block(prefix: str, columns: Sequence[str]) -> Column:
        entries = [part for c in columns for part in (F.lit(c), F.col(f"{prefix}{c}"))]
        return F.create_map(*entries) if entries else F.lit(None).cast("map<string,bigint>")

    grouped = {f"null_{c}" for c in config.mandatory} | {f"duplicate_{c}" for c in config.unique}
    document = F.struct(
        block("null_", config.mandatory).alias("mandatory_nulls"),
        block("duplicate_", config.unique).alias("duplicates"),
        *[F.col(n).alias(renames.get(n, n)) for n in names if n not in grouped],
    )
    counts = [part for name, frame in (sources or {}).items() for part in (F.lit(name), frame.agg(F.count("*")).scalar())]
    source_rows = F.create_map(*counts) if counts else F.lit(None).cast("map<string,bigint>")
    return checks.select(
        F.when(passed, "passed").otherwise("failed").alias("status"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at"),
        "final_rows",
        source_rows.alias("source_rows"),
        document.alias("checks"),
    )


class QualityFailure(ValueError):
    """A blocking check failed; nothing was published."""


def enforce(report: DataFrame) -> dict:
    """Collect the one-row report and raise unless it passed."""
    row = report.first().asDict(recursive=True)
    if row["status"] != "passed":
        raise QualityFailure(f"quality checks failed: {row['checks']}")
    return row
