"""Files: CSV, JSON, Parquet, the newest of a folder, raw copies, fingerprints."""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldspine import schema as S

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDINAL = "_ordinal"
# A longer line goes to a task in pieces of so many bytes.
PIECE_BYTES = 16 * 1024
# Endings of names that make readers of lines decompress a file, and the mark of UTF-8 they drop.
CODEC_ENDINGS = r"\.(gz|bz2|deflate|lz4|snappy|zst|passthrough)$"
_MARK = b"\xef\xbb\xbf"


def with_ordinal(df: DataFrame) -> DataFrame:
    """Add the row's place in its input: file, block, position within the block.

    Call it directly on a file scan. The id grows within a block and blocks
    are numbered by their byte offset, so the order is that of the file
    however it was split.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    return df.select("*", place.alias(ORDINAL))


def read_csv(
    spark: SparkSession, path: str | Sequence[str], columns: str, ordinal: bool = False, multi_line: bool = False
) -> DataFrame:
    """Header CSV with every column text, doubled quotes and empty cells null.

    ``columns`` is the DDL of the columns wanted; a file must have them all,
    in any order, among others. ``multi_line`` allows line breaks inside
    quotes, at the price of one task per file.
    """
    wanted = S.schema(columns)
    paths = [path] if isinstance(path, str) else list(path)
    header = spark.read.csv(
        paths, header=True, quote='"', escape='"', multiLine=multi_line, enforceSchema=False
    )
    S.require_columns(header, wanted.fieldNames(), "csv")
    df = with_ordinal(header) if ordinal else header
    return df.select(*wanted.fieldNames(), *([ORDINAL] if ordinal else []))


def read_json(spark: SparkSession, path: str | Sequence[str], columns: str, ordinal: bool = False, lines: bool = False) -> DataFrame:
    """JSON records: an array per file, or one record per line for large inputs."""
    df = spark.read.schema(S.schema(columns)).option("multiLine", not lines).json(path)
    return with_ordinal(df) if ordinal else df


def read_parquet(spark: SparkSession, path: str | Sequence[str], required: Iterable[str] = (), ordinal: bool = False) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    df = S.require_columns(spark.read.parquet(*paths), required, "parquet")
    return with_ordinal(df) if ordinal else df


def list_files(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of the files below ``path``; reads no content.

    Empty files are left out, as in every Spark file source.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.load(paths).select("path", "length", "modificationTime")


class NoSuchFile(FileNotFoundError):
    """A required file is absent."""


def newest_file(spark: SparkSession, folder: str, patterns: Sequence[str], required: bool = True) -> str | None:
    """Path of the most recently modified file matching any of ``patterns``."""
    if not path_exists(spark, folder):
        newest = None
    else:
        found = [list_files(spark, folder, pattern) for pattern in patterns]
        union = found[0]
        for frame in found[1:]:
            union = union.unionAll(frame)
        newest = union.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if newest is None and required:
        raise NoSuchFile(f"no file in {folder} matches {list(patterns)}")
    return newest


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).schema
        return True
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def raw_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, length, block, position, line): the bytes of every file between line feeds, in order by block and position.

    Spark's own reader splits files of any size over tasks, in any store it can
    read, and takes any bytes for a line. Files with a name of a compression
    codec, which it would decompress, come as one row with all their bytes and
    a null position; these may have up to 2 GiB. Empty files are left out.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("recursiveFileLookup", True)
    meta = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_block_start").alias("block")
    # A filter of the path alone is one of the listing, and the files it leaves out are not opened.
    plain = reader.option("lineSep", "\n").text(paths).where(~F.col("_metadata.file_path").rlike(CODEC_ENDINGS))
    lines = plain.select(*meta, F.monotonically_increasing_id().alias("position"), F.col("value").cast("binary").alias("line"))
    whole = reader.format("binaryFile").load(paths).where(F.col("path").rlike(CODEC_ENDINGS)).select(
        "path", "length", F.lit(0).cast("bigint").alias("block"), F.lit(None).cast("bigint").alias("position"), F.col("content").alias("line")
    )
    return lines.unionAll(whole)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each file from its lines, which come in order. Whether the last line had an end, and the first
    a mark before it, follows from the length of the file."""
    name, length, states, seen = None, 0, [], 0

    def done() -> pa.RecordBatch:
        rest = length - seen
        state = states[1] if rest >= len(_MARK) else states[0]
        if rest in (1, 1 + len(_MARK)):
            state.update(b"\n")
        elif rest not in (0, len(_MARK)):
            raise ValueError(f"{name}: {seen} bytes read of {length}")
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([length], pa.int64()), pa.array([state.hexdigest()])], names=["path", "length", "sha256"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("path", "length", "position", "piece", "line"))
        for path, size, position, piece, line in zip(*columns):
            if path != name:
                if name is not None:
                    yield done()
                name, length, states, seen = path, size, [hashlib.sha256(), hashlib.sha256(_MARK)], 0
            elif position is not None and piece == 0:
                line = b"\n" + line
            seen += len(line)
            for state in states:
                state.update(line)
    if name is not None:
        yield done()


def fingerprints(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, length, sha256) of every file, whatever its size and store.

    A hash goes over a file from its beginning to its end, so the lines of a
    file meet, sorted, in one task, which holds a batch of them at a time.
    """
    n = F.octet_length("line")
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(PIECE_BYTES))
    pieces = raw_lines(spark, path).select(
        "path", "length", "block", "position", F.posexplode(F.transform(starts, lambda s: F.substring(F.col("line"), s + 1, F.lit(PIECE_BYTES)))).alias("piece", "line")
    )
    ordered = pieces.repartition("path").sortWithinPartitions("path", "block", "position", "piece")
    return ordered.select("path", "length", "position", "piece", "line").mapInArrow(_fold, "path string, length bigint, sha256 string")


def plain_path(path: str) -> str:
    """The path as it appears inside the full names Spark reports."""
    return re.sub(r"^file:/*", "/", path.rstrip("/"))


def name_within(outputs: str | Sequence[str]) -> Column:
    """A file's path below the output that holds it; its base name if it is the output."""
    inside = [
        F.when(F.contains("path", F.lit(plain_path(output) + "/")), F.substring_index("path", plain_path(output) + "/", -1))
        for output in ([outputs] if isinstance(outputs, str) else outputs)
    ]
    return F.coalesce(*inside, F.substring_index("path", "/", -1))


def combined_fingerprint(outputs: str | Sequence[str]) -> list:
    """Aggregates (files, bytes, sha256) over ``fingerprints`` rows of the outputs.

    One file keeps its own hash. Several are combined by exclusive-or of the
    hashes of (path below the output, hash), which needs no order and is
    reduced in the map tasks. A path occurs once, so no two entries cancel.
    """
    entry = F.sha2(F.concat_ws("|", name_within(outputs), "sha256"), 256)
    words = [F.conv(F.substr(entry, F.lit(1 + 16 * i), F.lit(16)), 16, -10).cast("bigint") for i in range(4)]
    mixed = F.concat(*[F.lower(F.lpad(F.hex(F.bit_xor(word)), 16, "0")) for word in words])
    return [
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.when(F.count("*") == 1, F.max("sha256")).otherwise(mixed).alias("sha256"),
    ]


def write_raw(spark: SparkSession, path: str | Sequence[str], folder: str) -> str:
    """Keep byte-identical copies beside parsed output, as rows of ``raw_lines`` for files of any size."""
    raw_lines(spark, path).write.option("compression", "zstd").parquet(folder)
    return folder


def stored_bytes(copies: DataFrame) -> DataFrame:
    """(path, length, block, position, chunk) of copies kept by ``write_raw``: chunks in order make up the file.

    How a file ended, and whether a mark stood at its beginning, follows from
    its length and the lengths of its lines, which alone are read for that.
    """
    place = F.struct("block", "position")
    files = copies.groupBy("path").agg(
        (F.max("length") - F.sum(F.octet_length("line") + 1)).alias("_rest"), F.min(place).alias("_first"), F.max(place).alias("_last")
    )
    joined = copies.join(files, "path")
    line, marked = F.col("line"), F.col("_rest") >= len(_MARK) - 1
    ended = ~(F.col("_rest").isin(-1, len(_MARK) - 1) & (place == F.col("_last")))
    first = marked & (place == F.col("_first"))
    chunk = F.when(F.col("position").isNull(), line).otherwise(
        F.concat(F.when(first, F.lit(_MARK)).otherwise(F.lit(b"")), line, F.when(ended, F.lit(b"\n")).otherwise(F.lit(b"")))
    )
    return joined.select("path", "length", "block", "position", chunk.alias("chunk"))
