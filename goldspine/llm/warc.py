"""WARC archives with an index, and reads of selected records by byte ranges.

Records are gzip members in files of a task each. The index has a row for each
record: file, offset, length, URL and digest. A reader takes index rows, sorts
them by file and offset, joins neighbours to one range, and reads ranges only.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window as W, functions as F

from goldspine.llm.keys import FP, ID, TEXT, keyed, public_id
from goldspine.sinks.staging import stage, staging_path

#: Equal payloads of as many bytes are archived once.
MIN_REVISIT = 100
#: A new file begins after so many bytes.
FILE_BYTES = 64 << 20
#: Ranges with a smaller gap are read as one, up to this length.
GAP_BYTES, RANGE_BYTES = 64 << 10, 4 << 20
#: What a task reads back, about, in many ranges.
TASK_BYTES = 32 << 20
_DATE = datetime(2000, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
_NAMES = uuid.UUID("6b1f4c7e-63c5-4a43-9a4f-0d6a6f5a9b10")
_INDEX = f"{ID} long, url string, record_type string, digest string, file string, offset long, length long"
_INDEX_TYPES = pa.schema(
    [(ID, pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Mounted folders and every store that pyarrow knows (s3, gs, hdfs, abfs)."""
    local = re.sub(r"^file:(//)?(?=/)", "", path)
    return (pafs.LocalFileSystem(), local) if local.startswith("/") else pafs.FileSystem.from_uri(path)


def _field(text: str) -> str:
    """A header's value: nothing that ends the line."""
    return re.sub(r"[\r\n]+", " ", text).strip()


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, str(page_id))}>"


def render(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: an HTTP response, or for a revisit its headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_field(url or 'about:blank')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        headers[2:2] = [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes | None]:
    """A record's headers, lower-cased names, and its payload; none for a revisit."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if headers["warc-type"] == "revisit":
        return headers, None
    return headers, block.partition(b"\r\n\r\n")[2]


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each attempt has files of its own; the index names those of the attempt that counts.
        filesystem, root = _filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page, url, html, digest, refers in zip(*(batch.column(c).to_pylist() for c in (ID, "url", TEXT, "digest", "refers_to"))):
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = filesystem.open_output_stream(f"{root}/{name}", compression=None)
                    data = gzip.compress(render(page, url, html.encode(), digest, refers), 4, mtime=0)
                    out.write(data)
                    rows.append((page, url, "response" if refers is None else "revisit", digest, name, offset, len(data)))
                    offset += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX_TYPES)] if rows else [pa.array([], f.type) for f in _INDEX_TYPES], schema=_INDEX_TYPES)
        finally:
            if out is not None:
                out.close()

    return write


def write_archive(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", text_column: str = "html") -> DataFrame:
    """Write a record for each row and return the index, written beside the archives.

    Of equal payloads of ``MIN_REVISIT`` bytes or more the smallest id is a
    response and the others are revisits of it. Null texts are empty payloads.
    Rows that share the smallest id are all responses; a null id ranks first.
    """
    rows = keyed(pages, id_column, text_column, F.col(url_column).cast("string").alias("url"))
    digests = rows.select(ID, FP, F.sha2(TEXT, 256).alias("digest"), F.octet_length(TEXT).alias("_bytes"))
    large = stage(digests.where(F.col("_bytes") >= MIN_REVISIT).distinct(), "warc-digests")
    firsts = stage(large.groupBy("digest").agg(F.min(ID).alias("refers_to"), F.max(ID).alias("_last")).where(F.col("refers_to") < F.col("_last")), "warc-firsts")
    revisits = large.join(firsts, "digest").where(F.col(ID) != F.col("refers_to")).select(ID, FP, "refers_to").distinct()
    records = rows.join(revisits, [ID, FP], "left").select(ID, "url", TEXT, F.sha2(TEXT, 256).alias("digest"), "refers_to")
    index = records.mapInArrow(_writer(folder), _INDEX)
    index.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")


def _ranges(index: DataFrame) -> DataFrame:
    """Index rows as ranges: neighbours of a file in one, by gap and length.

    A file's rows are laid out in tiles of ``RANGE_BYTES`` first, so that the
    rows that meet in one window are bounded whatever a file holds.
    """
    tiled = index.withColumn("_tile", F.floor(F.col("offset") / RANGE_BYTES))
    w = W.partitionBy("file", "_tile").orderBy("offset")
    fresh = F.coalesce(F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > GAP_BYTES, F.lit(True))
    numbered = tiled.withColumn("_fresh", fresh.cast("int")).withColumn("_range", F.sum("_fresh").over(w))
    parts = F.array_sort(F.collect_list(F.struct("offset", "length")))
    return numbered.groupBy("file", "_tile", "_range").agg(parts.alias("parts")).select("file", "parts")


_RECORD = f"{ID} long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_RECORD_TYPES = pa.schema([
    (ID, pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        for batch in batches:
            for name, parts in zip(batch.column("file").to_pylist(), batch.column("parts").to_pylist()):
                begin, end = parts[0]["offset"], max(p["offset"] + p["length"] for p in parts)
                with filesystem.open_input_file(f"{root}/{name}") as source:
                    data = source.read_at(end - begin, begin)
                rows = []
                for part in parts:
                    at = part["offset"] - begin
                    headers, payload = parse(zlib.decompress(data[at : at + part["length"]], 31))
                    digest = headers["warc-payload-digest"].removeprefix("sha256:")
                    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{name} at {part['offset']}: the payload has another digest")
                    refers = headers.get("x-refers-to-page")
                    size = int(headers["x-payload-length"])
                    if payload is not None and len(payload) != size:
                        raise ValueError(f"{name} at {part['offset']}: the payload has {len(payload)} bytes, {size} announced")
                    rows.append((
                        int(headers["x-page-id"]), headers["warc-target-uri"], headers["warc-type"], size if payload is None else len(payload), digest,
                        None if refers is None else int(refers), payload,
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD_TYPES)], schema=_RECORD_TYPES)

    return read


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows: ``_id, url, record_type, payload_bytes, payload_digest, refers_to, payload``.

    ``index`` may be any selection of an index. A payload is checked against its
    digest and its length; a revisit has none of its own. An empty selection
    gives no record. Ranges are dealt out by the bytes they are to read, not by
    the size of the index.
    """
    found = index.agg(F.sum("length").alias("bytes")).first().bytes or 0
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-found // TASK_BYTES))
    return _ranges(index).repartition(tasks).mapInArrow(_reader(folder), _RECORD)


def summary(pages: DataFrame) -> DataFrame:
    folder = staging_path(pages.sparkSession, "warc")
    index = write_archive(pages, folder)
    return read_archive(index, folder).select(
        public_id("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("refers_to") != -(1 << 63), F.col("refers_to")).alias("refers_to"),
    )


ORACLE = r"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM hashed WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT h.page_id, CAST(h.payload_bytes AS BIGINT) AS payload_bytes, h.payload_digest,
       CASE WHEN f.first_id < h.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < h.page_id THEN f.first_id END AS refers_to
FROM hashed h LEFT JOIN firsts f ON f.payload_digest = h.payload_digest AND h.payload_bytes >= 100
"""
