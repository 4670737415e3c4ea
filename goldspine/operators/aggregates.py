"""Grouped counts, sums and ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from goldspine.functions.numbers import ratio


def exact_sum(value: Column) -> Column:
    """Sum of a whole-number column without 64-bit overflow."""
    return F.sum(value.cast("decimal(19,0)"))


def group_counts(
    df: DataFrame, group: str, minimum: int = 1, keep: Column | None = None, count: str = "country_count"
) -> DataFrame:
    """Rows per non-null group holding at least ``minimum``, largest group first."""
    rows = df.where(F.col(group).isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    return (
        rows.groupBy(group)
        .agg(F.count("*").alias(count))
        .where(F.col(count) >= minimum)
        .orderBy(F.col(count).desc(), F.col(group).asc_nulls_last())
    )


def group_totals(facts: DataFrame, group: Sequence[str], measure: str, amount: str) -> DataFrame:
    """Decomposable totals of a fact table, the form to join and add up again.

    Sums are exact decimals, so the order of addition cannot change a result.
    """
    return facts.groupBy(*group).agg(
        F.count("*").alias("n"),
        F.count(measure).alias("n_measure"),
        exact_sum(F.col(measure)).alias("sum_measure"),
        F.sum(F.col(amount).cast("decimal(22,2)")).alias("sum_amount"),
    )


def group_statistics(totals: DataFrame, group: str, minimum_total: int) -> DataFrame:
    """Count, total, mean and weighted ratio per group from ``group_totals`` rows."""
    summed = totals.groupBy(group).agg(
        F.sum("n").alias("country_count"),
        F.sum("sum_measure").alias("total_population"),
        F.sum("n_measure").alias("_measured"),
        F.sum("sum_amount").alias("total_gdp_usd"),
    )
    whole = T.DecimalType(38, 0)
    kept = summed.where(F.col("total_population") >= minimum_total)
    return kept.select(
        group,
        "country_count",
        "total_population",
        ratio(
            F.col("total_population").cast("decimal(28,0)"), F.col("_measured").cast("decimal(19,0)"),
            T.DecimalType(28, 0), T.DecimalType(19, 0), 0,
        ).alias("average_population"),
        "total_gdp_usd",
        ratio(
            F.col("total_gdp_usd").cast("decimal(30,2)"), F.col("total_population").cast("decimal(28,0)"),
            T.DecimalType(30, 2), whole, 2,
        ).alias("weighted_gdp_per_capita_usd"),
    ).orderBy(F.col("total_population").desc_nulls_first(), F.col(group).asc_nulls_last())


def rows_per_source(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named frame in one pass over each."""
    tagged = [frame.select(F.lit(name).alias("source")) for name, frame in frames.items()]
    union = tagged[0]
    for frame in tagged[1:]:
        union = union.unionAll(frame)
    return union.groupBy("source").agg(F.count("*").alias("rows"))


def duplicate_count(column: str) -> Column:
    """Rows beyond the first of each value; nulls equal each other."""
    value = F.col(f"`{column}`")
    any_null = F.coalesce(F.max(value.isNull().cast("bigint")), F.lit(0))
    return F.count(F.lit(1)) - F.count_distinct(value) - any_null


def key_summary(df: DataFrame, columns: Sequence[str], **measures: Column) -> DataFrame:
    """Row count, distinct count of each column, and further measures, in one aggregate."""
    return df.agg(
        F.count("*").alias("row_count"),
        *[F.count_distinct(F.col(name)).alias(f"distinct_{name}") for name in columns],
        *[measure.alias(name) for name, measure in measures.items()],
    )
