"""Published star tables: immutable Parquet folders and an append-only load log.

A table's version is a list of folders no one rewrites, each with the rows of one
bucket of ids. The log row that says ``success`` names the versions that are
current, so several tables change together or not at all, and a reader never
sees a half-written load. A change writes folders for the buckets it touches and
takes over the others.

Which change follows another is settled by claims. A claim holds its load's id
and a time after which it no longer counts; it is moved into place by a rename
that does not overwrite. A later load may take over a claim that has run out
without a success, by claiming the next attempt, and of several rows for one
place the last attempt counts, so a load that was taken for dead changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta, timezone
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from goldspine import schema as S
from goldspine.operators.dedupe import latest_per_key

LOG = S.AUDIT + ", kind string, versions map<string,string>, base string, attempt int"
# The keys of the published tables.
IDS = {
    "region": "region_id",
    "subregion": "subregion_id",
    "country": "country_id",
    "country_indicator": "country_indicator_id",
}
# Descriptions kept with the published tables.
COMMENTS = {
    "country": "Consolidated reference of countries, without personal data.",
    "country_indicator": "Yearly statistical indicators of a country.",
    "data_load_audit": "Technical trace of the loads, without their content.",
}


class ConcurrentLoad(RuntimeError):
    """Another load published after this one started."""


class StarStore:
    """``buckets``: parts of each table, the same for all who open the store; ``lease``: how long a claim counts."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, lease: timedelta = timedelta(minutes=10)):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.lease = lease

    def _log(self) -> DataFrame:
        layout = S.schema(LOG)
        try:
            return self.spark.read.schema(layout).parquet(f"{self.root}/load_log")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], layout)

    def _append(self, row: Mapping[str, Any]) -> None:
        layout = S.schema(LOG)
        values = tuple(row.get(name) for name in layout.fieldNames())
        self.spark.createDataFrame([values], layout).coalesce(1).write.mode("append").parquet(f"{self.root}/load_log")

    def audit(self) -> DataFrame:
        """One row per load with its last known state."""
        loads = self._log().where(F.col("kind") == "load")
        return latest_per_key(loads, ["load_id"], "completed_at", ("status",)).select(*S.schema(S.AUDIT).fieldNames())

    def head(self) -> tuple[str | None, dict[str, str]]:
        """(id of the newest published change, table name to version folder)."""
        done = self._log().where(F.col("status") == "success")
        # One row for each place in the chain of changes: that of the last attempt.
        last = F.max_by(F.struct("load_id", "completed_at", "versions"), F.struct(F.coalesce("attempt", F.lit(0)), "completed_at"))
        done = done.groupBy(F.when(F.col("attempt").isNull(), F.col("load_id")).alias("old"), "base").agg(last.alias("x")).select("x.*")
        newest = done.orderBy(F.col("completed_at").desc(), F.col("load_id").desc()).limit(1).collect()
        return (newest[0]["load_id"], dict(newest[0]["versions"] or {})) if newest else (None, {})

    def bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(IDS[name])), F.lit(self.buckets)).cast("int")

    def table(self, name: str, versions: Mapping[str, str] | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The current version of a table, or of some of its buckets; empty before the first load."""
        versions = self.head()[1] if versions is None else versions
        layout = S.schema(S.STAR_TABLES[name])
        folders = _folders(versions.get(name))
        if buckets is not None:
            wanted = set(buckets)
            folders = [f for f in folders if _bucket_of(f) in wanted]
        if not folders:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(*folders)

    def touched(self, name: str, rows: DataFrame) -> set[int]:
        """The buckets of rows that have the table's id: at most as many as there are buckets."""
        return {r[0] for r in rows.select(self.bucket(name)).distinct().collect()}

    def write_version(
        self, name: str, df: DataFrame, load_id: str, versions: Mapping[str, str] | None = None, replaces: Iterable[int] | None = None
    ) -> str:
        """Write ``df`` and return the table's new version.

        With ``replaces``, ``df`` takes the place of these buckets of
        ``versions`` (of none: it is added); else it is the whole table.
        """
        path = f"{self.root}/{name}/version={load_id}"
        aligned = S.align(df, S.STAR_TABLES[name])
        # Parquet keeps descriptions by column: the table's is kept with its first one.
        comments = {aligned.columns[0]: COMMENTS[name]} if name in COMMENTS else {}
        placed = S.describe(aligned, comments).withColumn("bucket", self.bucket(name)).hint("rebalance", "bucket")
        placed.write.option("compression", "zstd").partitionBy("bucket").parquet(path)
        written = [s.getPath().toString() for s in self._files().listStatus(self._path(path)) if s.isDirectory()]
        kept = []
        if replaces is not None:
            gone = set(replaces)
            kept = [f for f in _folders((versions or {}).get(name)) if _bucket_of(f) not in gone]
        return json.dumps(kept + sorted(written))

    def begin(self, source_file: str, source_sha256: str, rows_read: int) -> dict[str, Any]:
        row = {
            "load_id": str(uuid.uuid4()),
            "source_file": source_file,
            "source_sha256": source_sha256,
            "started_at": _now(),
            "status": "started",
            "rows_read": rows_read,
            "countries_inserted": 0,
            "countries_updated": 0,
            "indicators_upserted": 0,
            "kind": "load",
        }
        self._append(row)
        return row

    def commit(self, row: Mapping[str, Any], base: str | None, versions: Mapping[str, str], **counters: int) -> None:
        """Make ``versions`` current, unless something was published since ``base``."""
        if self.head()[0] != base:
            raise ConcurrentLoad(f"tables changed since {base}")
        attempt, until = self._claim(row["load_id"], base)
        try:
            if _now() >= until:
                raise ConcurrentLoad(f"the claim on {base} has run out")
            self._append({
                **row, **counters, "completed_at": _now(), "status": "success", "versions": dict(versions), "base": base, "attempt": attempt,
            })
        except BaseException:
            self._files().delete(self._path(self._claims(base, attempt)), False)
            raise

    def _claims(self, base: str | None, attempt: int | None = None) -> str:
        folder = f"{self.root}/claims/after={base or 'nothing'}"
        return folder if attempt is None else f"{folder}/attempt={attempt:06d}"

    def _last_claim(self, base: str | None) -> tuple[int, dict[str, str]]:
        """(number, content) of the last claim on the place after ``base``; (-1, {}) of none."""
        files, folder = self._files(), self._path(self._claims(base))
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        last = max((int(n.split("=")[1]) for n in names if n.startswith("attempt=")), default=-1)
        if last < 0:
            return last, {}
        stream = files.open(self._path(self._claims(base, last)))
        try:
            return last, json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _claim(self, load_id: str, base: str | None) -> tuple[int, datetime]:
        """Claim the place after ``base``: (number of the attempt, until when it counts)."""
        last, held = self._last_claim(base)
        if last >= 0:
            if not self._log().where((F.col("status") == "success") & (F.col("load_id") == held["load_id"])).isEmpty():
                raise ConcurrentLoad(f"{held['load_id']} follows {base}")
            if _now() < datetime.fromisoformat(held["until"]):
                raise ConcurrentLoad(f"{held['load_id']} is about to follow {base}")
        until = _now() + self.lease
        own = self._path(f"{self.root}/claims/of={load_id}")
        target = self._path(self._claims(base, last + 1))
        files, hadoop = self._files(), self.spark.sparkContext._jvm.org.apache.hadoop.fs
        files.mkdirs(target.getParent())
        stream = files.create(own, True)
        stream.write(json.dumps({"load_id": load_id, "until": until.isoformat()}).encode())
        stream.close()
        # This rename fails where the target exists, whoever made it.
        context = hadoop.FileContext.getFileContext(own.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(own), files.makeQualified(target), options)
        except Py4JJavaError as error:
            files.delete(own, False)
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            raise ConcurrentLoad(f"another load follows {base}") from error
        return last + 1, until

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        """The file system of the store."""
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def fail(self, row: Mapping[str, Any], error: BaseException) -> None:
        self._append({**row, "completed_at": _now(), "status": "failed", "error_message": str(error)[:4000]})

    def publish(self, tables: Mapping[str, DataFrame], replaces: Mapping[str, Iterable[int]] | None = None) -> dict[str, str]:
        """Publish edited tables together; the others keep their version.

        A table named in ``replaces`` comes as the rows of these buckets only.
        """
        base, versions = self.head()
        row = {"load_id": str(uuid.uuid4()), "source_file": "edit", "source_sha256": "", "started_at": _now(),
               "rows_read": 0, "countries_inserted": 0, "countries_updated": 0, "indicators_upserted": 0, "kind": "edit"}
        replaces = replaces or {}
        written = {name: self.write_version(name, df, row["load_id"], versions, replaces.get(name)) for name, df in tables.items()}
        versions = {**versions, **written}
        self.commit(row, base, versions)
        return versions

    def describe(self) -> DataFrame:
        """(table, comment, version) of the published tables."""
        versions = self.head()[1]
        rows = [(n, COMMENTS.get(n), versions.get(n)) for n in (*S.STAR_TABLES, "data_load_audit")]
        return self.spark.createDataFrame(rows, "table string, comment string, version string")


def _folders(version: str | None) -> list[str]:
    return json.loads(version) if version else []


def _bucket_of(folder: str) -> int:
    return int(re.search(r"bucket=(\d+)/?$", folder)[1])


def _now() -> datetime:
    return datetime.now(timezone.utc)


def timestamp_literal(value: datetime):
    return F.lit(value).cast(T.TimestampType())
