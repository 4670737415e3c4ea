"""Match the sources on a spine and pick every field from its best source."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldspine import schema as S
from goldspine.config import COUNTRIES, RAW_PATTERNS, REPORT_NAMES, Consolidation
from goldspine.functions.numbers import frame_ratio
from goldspine.functions.provenance import contributing, contributor_count, survivor
from goldspine.operators.dedupe import assert_unique
from goldspine.operators.quality import enforce, quality_report
from goldspine.plans.standardize import STANDARDS, standardize, standardize_scraping
from goldspine.sinks.documents import slug, write_document, write_table
from goldspine.sinks.staging import stage
from goldspine.sources.files import read_csv, read_json, read_parquet
from goldspine.sources.manifest import manifest_outputs, newest_manifest, newest_output


def merge_sources(
    sources: Mapping[str, DataFrame],
    config: Consolidation = COUNTRIES,
    match: Mapping[str, str] | None = None,
    processed_at: Column | None = None,
    check: bool = False,
) -> DataFrame:
    """One golden record per spine key.

    ``sources`` are standardised frames in provenance order, each with one row
    per key. ``match`` says which source matches by ``code`` or by ``name``;
    the default is the code wherever the frame has that column. Code joins
    reuse the partitioning left by the deduplication, so each source crosses
    the network once; the spine moves once more for the name-matched sources.

    ``check`` verifies beforehand that matched keys are unique, which costs an
    aggregate per key; otherwise the sources must come from ``standardize``
    and the spine's names must be unique if any source matches by name.
    """
    if config.spine not in sources:
        raise ValueError(f"the spine source {config.spine!r} is required")
    match = match or {}
    key, name_key = config.key, config.name_key
    spine = sources[config.spine]
    joined = spine.select(
        key,
        F.col(name_key),
        *[F.col(c).alias(f"{c}__{config.spine}") for c in config.spine_columns],
    )
    presence = {config.spine: f"{config.name}__{config.spine}"}
    for source, frame in sources.items():
        if source == config.spine:
            continue
        by_code = match.get(source, "code" if key in frame.columns else "name") == "code"
        payload = frame.drop("source", name_key if by_code else key)
        on = key if by_code else name_key
        if check:
            assert_unique(payload, [on], f"source {source}")
            if not by_code:
                assert_unique(spine, [name_key], "spine names")
        payload = payload.select(
            F.col(on), *[F.col(c).alias(f"{c}__{source}") for c in payload.columns if c != on]
        )
        joined = joined.join(payload, key, "left") if by_code else _join_by_name(joined, payload, key, name_key)
        presence[source] = f"{config.name}__{source}"
    seen = {s: F.col(c).isNotNull() for s, c in presence.items() if c in joined.columns}
    return _assemble(joined, config, seen, processed_at)


def _join_by_name(joined: DataFrame, payload: DataFrame, key: str, name_key: str) -> DataFrame:
    # Rows without a name match nothing; giving each its own key (normalised
    # names never hold "#") keeps them from meeting in one task.
    spread = F.coalesce(F.col(name_key), F.concat(F.lit("#"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    right = payload.where(F.col(name_key).isNotNull()).withColumnRenamed(name_key, "_name")
    return joined.withColumn("_name", spread).join(right, "_name", "left").drop("_name")


def _assemble(joined: DataFrame, config: Consolidation, seen: Mapping[str, Column], processed_at: Column | None) -> DataFrame:
    target = S.schema(config.canonical)
    types = {f.name: f.dataType for f in target.fields}
    available = joined.columns
    fields = {
        field: survivor([f"{field}__{s}" for s in order], available, types[field].simpleString())
        for field, order in config.priority.items()
    }
    for column in config.spine_columns:
        if column not in fields:
            fields[column] = F.col(f"{column}__{config.spine}")
    golden = joined.select(
        config.key,
        *[value.alias(name) for name, value in fields.items()],
        contributor_count(seen).alias("source_count"),
        contributing(seen).alias("sources"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"),
    )
    ratios = {r.name: frame_ratio(golden, r.numerator, r.denominator, r.places) for r in config.ratios}
    return S.align(golden.withColumns(ratios), target)


def load_source(spark: SparkSession, name: str, path: str, aliases: Mapping[str, str]) -> DataFrame:
    """Read one raw output of a source and standardise it."""
    if name == "file":
        raw = read_csv(spark, path, S.CODE_FILE, ordinal=True)
    elif name in ("api", "scraping"):
        layout = S.API_RECORD if name == "api" else S.SCRAPED_RECORD
        raw = read_json(spark, path, layout, ordinal=True, lines=not path.endswith(".json"))
    else:
        raw = read_parquet(spark, path, ordinal=True)
    if name == "scraping":
        return standardize_scraping(raw, aliases)
    return standardize(raw, STANDARDS[name], aliases)


def discover(spark: SparkSession, root: str, raw: str = "data/raw", allow_missing: bool = False) -> dict[str, str]:
    """The raw output of every source.

    By default those of the newest run manifest, all verified. With
    ``allow_missing`` the newest output of each folder; only the spine must exist.
    """
    if not allow_missing:
        manifest = newest_manifest(spark, f"{root}/{raw}")
        return manifest_outputs(spark, manifest, root, raw, list(RAW_PATTERNS))
    found = {}
    for name, pattern in RAW_PATTERNS.items():
        path = newest_output(spark, f"{root}/{raw}/{name}", pattern, required=name == COUNTRIES.spine)
        if path is not None:
            found[name] = path
    return found


@dataclass(frozen=True)
class Consolidated:
    table: str
    csv: str
    report: str
    lineage: str


def run(
    spark: SparkSession,
    root: str,
    raw: str = "data/raw",
    allow_missing: bool = False,
    config: Consolidation = COUNTRIES,
) -> Consolidated:
    """Raw outputs to published golden records; nothing is written unless all checks pass."""
    paths = discover(spark, root, raw, allow_missing)
    sources = {n: stage(load_source(spark, n, p, config.aliases), n) for n, p in paths.items()}
    golden = stage(merge_sources(sources, config, check=True), "golden")
    report = enforce(quality_report(golden, config.quality, sources, REPORT_NAMES))
    stamp = slug()
    outputs = Consolidated(
        table=f"{root}/data/processed/countries_consolidated_{stamp}.parquet",
        csv=f"{root}/data/processed/countries_consolidated_{stamp}.csv",
        report=f"{root}/data/quality/quality_report_{stamp}.json",
        lineage=f"{root}/data/quality/lineage_{stamp}.json",
    )
    ordered = golden.orderBy(config.key)
    write_table(ordered, outputs.table, "parquet", compression="zstd")
    write_table(ordered, outputs.csv, "csv")
    write_document(spark, report, outputs.report)
    write_document(spark, {"generated_at": report["generated_at"], "inputs": paths}, outputs.lineage)
    return outputs


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(row[0] for row in spark.read.text(path).collect()))
