"""Create, replace and delete rows of the published tables, in batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from goldspine import schema as S
from goldspine.operators.crud import REASON, ForeignKey, create_rows, judge_replacements, replace_rows, split
from goldspine.operators.joins import lookup
from goldspine.operators.quality import country_rules, indicator_rules, region_rules, subregion_rules
from goldspine.operators.referential import cascade_delete, delete_rows, set_null
from goldspine.operators.upsert import assign_ids
from goldspine.plans.star_store import IDS, StarStore
from goldspine.sinks.staging import stage

# Constraints of the published tables.
UNIQUE = {
    "region": [["region_name"]],
    "subregion": [["region_id", "subregion_name"]],
    "country": [["iso2"], ["iso3"]],
    "country_indicator": [["country_id", "indicator_year"]],
}
REFERENCES = {
    "region": [],
    "subregion": [("region_id", "region")],
    "country": [("region_id", "region"), ("subregion_id", "subregion")],
    "country_indicator": [("country_id", "country")],
}
RULES = {
    "region": region_rules,
    "subregion": subregion_rules,
    "country": country_rules,
    "country_indicator": indicator_rules,
}


@dataclass(frozen=True)
class Edit:
    """Rows that were applied and rows that were not, the latter with a reason."""

    applied: DataFrame
    rejected: DataFrame


def _prepare(batch: DataFrame, table: str, keep: list[str]) -> DataFrame:
    now = F.current_timestamp()
    defaults = {"created_at": now, "loaded_at": now, "processed_at": now, "source_count": F.lit(1)}
    layout = S.schema(S.STAR_TABLES[table])
    names = layout.fieldNames()
    kept = T.StructType([*layout.fields, *[batch.schema[c] for c in keep if c not in names]])
    aligned = S.align(batch, kept, {k: v for k, v in defaults.items() if k in names})
    if table == "country":
        aligned = aligned.withColumns({c: F.upper(c) for c in ("iso2", "iso3")})
    return aligned


def _foreign_keys(store: StarStore, table: str) -> list[ForeignKey]:
    return [ForeignKey(column, store.table(parent), IDS[parent]) for column, parent in REFERENCES[table]]


def create(store: StarStore, table: str, batch: DataFrame, ordinal: str) -> Edit:
    """Insert the sound rows of ``batch`` (without ids), judged in ``ordinal`` order. Only these are written."""
    existing = store.table(table)
    prepared = _prepare(batch, table, [ordinal]).drop(IDS[table])
    judged = stage(
        create_rows(prepared, existing, UNIQUE[table], ordinal, RULES[table](), _foreign_keys(store, table)), "create"
    )
    accepted, rejected = split(judged)
    start = existing.agg(F.max(IDS[table])).first()[0] or 0
    numbered = assign_ids(accepted.drop(ordinal), IDS[table], start).select(*existing.columns)
    numbered = stage(numbered, "created")
    store.publish({table: numbered}, {table: ()})
    return Edit(numbered, rejected)


def replace(store: StarStore, table: str, batch: DataFrame) -> Edit:
    """Replace whole rows by id, as one batch.

    Only the buckets of replaced rows are written anew. Rows with an unknown or repeated id are rejected first, then those that
    break a rule or a reference. The others are judged in the order of their
    ids against every stored row that keeps its values, which includes the
    stored rows of rejected ones.
    """
    id_column = IDS[table]
    existing = store.table(table)
    prepared = _prepare(batch, table, [])
    if "created_at" in existing.columns:
        stored = existing.select(id_column, F.col("created_at").alias("_created"))
        prepared = prepared.join(stored, id_column, "left").withColumn("created_at", F.coalesce("_created", "created_at")).drop("_created")
    prepared = stage(prepared, "replace")
    counts = prepared.groupBy(id_column).agg(F.count("*").alias("_n"))
    once = counts.where("_n = 1").join(existing.select(id_column), id_column, "left_semi").select(id_column)
    known = prepared.join(once, id_column, "left_semi")
    unsound = prepared.join(once, id_column, "left_anti").join(counts, id_column, "left").withColumn(
        REASON, F.when(F.col("_n") > 1, F.lit(f"repeated {id_column}")).otherwise(F.lit("not found"))
    ).drop("_n")
    judged = judge_replacements(known, existing, UNIQUE[table], id_column, RULES[table](), _foreign_keys(store, table))
    accepted, rejected = split(judged)
    refresh = {"loaded_at": F.current_timestamp()} if "loaded_at" in existing.columns else {}
    touched = store.touched(table, accepted)
    after, _ = replace_rows(store.table(table, buckets=touched), accepted, id_column, refresh)
    store.publish({table: after}, {table: touched})
    return Edit(accepted, rejected.unionByName(unsound))


def delete(store: StarStore, table: str, ids: DataFrame) -> Edit:
    """Delete by id with the tables' referential actions.

    A region with subregions stays. Countries lose a deleted region or
    subregion. A deleted country takes its indicators along.
    """
    id_column = IDS[table]
    existing = store.table(table)
    ids = stage(ids.select(id_column), "ids")
    restricting = store.table("subregion") if table == "region" else None
    outcome = delete_rows(existing, ids, id_column, restricting, id_column)
    deleted = stage(outcome.deleted, "deleted")
    touched = {table: store.touched(table, deleted)}
    changed = {table: store.table(table, buckets=touched[table]).join(deleted, id_column, "left_anti")}
    # Of a table of children only the buckets that hold one are written anew.
    children = "country" if table in ("region", "subregion") else "country_indicator" if table == "country" else None
    if children:
        touched[children] = store.touched(children, lookup(store.table(children), deleted, [id_column], "left_semi"))
        follow = cascade_delete if table == "country" else set_null
        changed[children] = follow(store.table(children, buckets=touched[children]), deleted, id_column, id_column)
    rejected = outcome.blocked.withColumn(REASON, F.lit("still referenced")).unionByName(
        outcome.missing.withColumn(REASON, F.lit("not found"))
    )
    store.publish(changed, touched)
    return Edit(deleted, rejected)
