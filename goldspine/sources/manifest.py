"""Run manifests: which files a run wrote, and whether they are still those files."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from goldspine.sinks.documents import slug, write_document
from goldspine.sources.files import NoSuchFile, combined_fingerprint, fingerprints, list_files, name_within, plain_path


class ManifestError(ValueError):
    """A manifest is incomplete or no longer describes the files."""


def newest_output(spark: SparkSession, folder: str, pattern: str, required: bool = True) -> str | None:
    """The newest output of a folder: a file, or the directory one job wrote."""
    try:
        listed = list_files(spark, f"{folder}/{pattern}")
        newest = listed.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        newest = None
    if newest is None:
        if required:
            raise NoSuchFile(f"nothing in {folder} matches {pattern}")
        return None
    inside = plain_path(folder) + "/"
    name = plain_path(newest).partition(inside)[2].split("/")[0]
    return f"{folder.rstrip('/')}/{name}"


def newest_manifest(spark: SparkSession, raw: str) -> str:
    return newest_output(spark, raw, "manifest_*.json")


def build_entry(spark: SparkSession, source: str, root: str, output: str, rows: int) -> dict[str, Any]:
    """The manifest entry of one written output; ``output`` is relative to ``root``."""
    found = fingerprints(spark, f"{root}/{output}").agg(*combined_fingerprint(f"{root}/{output}")).first()
    return {
        "source": source,
        "output_file": output,
        "rows": int(rows),
        "files": int(found["files"]),
        "bytes": int(found["bytes"] or 0),
        "sha256": found["sha256"],
        "extracted_at": datetime.now(timezone.utc).isoformat(),
        "status": "success",
    }


def run_sources(
    spark: SparkSession,
    jobs: Mapping[str, Callable[[], tuple[str, int]]],
    root: str,
    raw: str = "data/raw",
    continue_on_error: bool = False,
) -> str:
    """Run each source's job and write the run manifest; returns its path.

    A job writes its output and returns (path relative to ``root``, rows). A
    failure is recorded; the remaining sources run only if asked to.
    """
    manifest: dict[str, Any] = {"run_id": slug(), "results": [], "errors": []}
    for source, job in jobs.items():
        try:
            output, rows = job()
            manifest["results"].append(build_entry(spark, source, root, output, rows))
        except Exception as error:  # the manifest is where a source's failure belongs
            manifest["errors"].append({"source": source, "error": str(error)})
            if not continue_on_error:
                break
    # Beside the manifest, an entry for each file of the outputs.
    if manifest["results"]:
        outputs = {entry["source"]: f"{root}/{entry['output_file']}" for entry in manifest["results"]}
        file_entries(spark, outputs).write.parquet(f"{root}/{raw}/files_{manifest['run_id']}")
    path = f"{root}/{raw}/manifest_{manifest['run_id']}.json"
    return write_document(spark, manifest, path)


def read_manifest(spark: SparkSession, path: str) -> Any:
    return json.loads("\n".join(row[0] for row in spark.read.text(path, wholetext=True).collect()))


def manifest_outputs(
    spark: SparkSession, manifest_path: str, root: str, raw: str, sources: Sequence[str]
) -> dict[str, str]:
    """Source to verified output path, or ``ManifestError``.

    Every source exactly once and successful, no error recorded, every path
    inside its source's folder, and bytes, hash and row count as recorded.
    """
    manifest = read_manifest(spark, manifest_path)
    results = manifest.get("results") if isinstance(manifest, dict) else None
    if not isinstance(results, list) or manifest.get("errors"):
        raise ManifestError(f"incomplete run: {manifest_path}")
    recorded = [entry.get("source") if isinstance(entry, dict) else None for entry in results]
    if sorted(map(str, recorded)) != sorted(sources):
        raise ManifestError(f"sources absent or repeated in {manifest_path}: {recorded}")
    outputs = {}
    for entry in results:
        source, output = entry["source"], entry.get("output_file")
        if entry.get("status") != "success":
            raise ManifestError(f"source {source} did not succeed")
        if not isinstance(output, str) or not _inside(output, f"{raw}/{source}"):
            raise ManifestError(f"output of {source} lies outside its folder: {output}")
        if not isinstance(entry.get("rows"), int) or entry["rows"] < 1:
            raise ManifestError(f"output of {source} is empty")
        outputs[source] = f"{root}/{output}"
    broken = verify_entries(spark, {e["source"]: (f"{root}/{e['output_file']}", e.get("bytes"), e.get("sha256")) for e in results})
    problems = [row.asDict() for row in broken.where("problem is not null").orderBy("source").collect()]
    if problems:
        raise ManifestError(f"raw output changed since the manifest: {problems}")
    return {source: outputs[source] for source in sources}


def _inside(path: str, folder: str) -> bool:
    clean = posixpath.normpath(path.replace("\\", "/"))
    return clean.startswith(posixpath.normpath(folder) + "/")


def verify_entries(spark: SparkSession, entries: Mapping[str, tuple[str, int | None, str | None]]) -> DataFrame:
    """(source, files, bytes, sha256, problem) for recorded (path, bytes, hash); one row per source.

    All files of all sources are fingerprinted by one job.
    """
    recorded = spark.createDataFrame(
        [(source, path.rstrip("/"), size, digest) for source, (path, size, digest) in entries.items()],
        "source string, output string, recorded_bytes bigint, recorded_sha256 string",
    )
    present = [path for path, _, _ in entries.values()]
    if not _exists(spark, present):
        present = [path for path in present if _exists(spark, path)]
    if not present:
        return recorded.select(
            "source", F.lit(0).cast("bigint").alias("files"), F.lit(0).cast("bigint").alias("bytes"),
            F.lit(None).cast("string").alias("sha256"), F.lit("missing").alias("problem"),
        )
    # One literal per source: the list is the configured sources, not data.
    owner = F.coalesce(
        *[
            F.when(F.col("path").contains(plain_path(path) + "/") | F.col("path").endswith(plain_path(path)), F.lit(source))
            for source, (path, _, _) in entries.items()
        ]
    )
    actual = fingerprints(spark, present).withColumn("source", owner).groupBy("source").agg(*combined_fingerprint(present))
    joined = recorded.join(actual, "source", "left")
    problem = (
        F.when(F.col("files").isNull(), "missing")
        .when(~F.col("bytes").eqNullSafe(F.col("recorded_bytes")), "bytes differ")
        .when(~F.col("sha256").eqNullSafe(F.col("recorded_sha256")), "sha256 differs")
    )
    return joined.select("source", "files", "bytes", "sha256", problem.alias("problem"))


def file_entries(spark: SparkSession, outputs: Mapping[str, str]) -> DataFrame:
    """(source, file, bytes, sha256): an entry for each file of the outputs; ``file`` is its path below its output."""
    rows = None
    for source, output in outputs.items():
        found = fingerprints(spark, output).select(
            F.lit(source).alias("source"), name_within(output).alias("file"), F.col("length").alias("bytes"), "sha256"
        )
        rows = found if rows is None else rows.unionAll(found)
    return rows


def compare_entries(recorded: DataFrame, present: DataFrame) -> DataFrame:
    """(source, file, state) of recorded and present entries: unchanged, changed, added or removed."""
    old = recorded.select("source", "file", F.struct("bytes", "sha256").alias("_old"))
    new = present.select("source", "file", F.struct("bytes", "sha256").alias("_new"))
    state = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") == F.col("_new"), "unchanged").otherwise("changed")
    )
    return old.join(new, ["source", "file"], "full_outer").select("source", "file", state.alias("state"))


def _exists(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether every path exists; the reader checks that before any job."""
    try:
        list_files(spark, path)
        return True
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def run_tally(spark: SparkSession, manifest_path: str) -> DataFrame:
    """(status, sources): how many sources of a run succeeded and failed."""
    manifest = read_manifest(spark, manifest_path)
    rows = [(e["source"], "success") for e in manifest["results"]] + [(e["source"], "error") for e in manifest["errors"]]
    frame = spark.createDataFrame(rows, "source string, status string")
    return frame.groupBy("status").agg(F.count("*").alias("sources"))
