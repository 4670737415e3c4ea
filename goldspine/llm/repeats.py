"""Suffix-array dedup: bytes that an earlier place of the corpus holds already.

Every byte position with ``WIDTH`` bytes after it is a suffix, and suffixes are
ordered only as far as these bytes. The order is a radix sort, most significant
digit first, in which a group of one drops out after each pass:

1. The first digit is the gram that a window's minimum hash falls on. Equal
   windows have equal grams at equal places, so suffixes that share one travel
   as one run: a row for some 36 suffixes.
2. The second digit is all bytes of a run. Of equal runs, all but the first
   are repeats as a whole and leave the sort.
3. Runs with an equal gram but other bytes go on with their bytes, and their
   suffixes are told apart through the last byte.

Digits of a pass are compared as hashes, 128 bits in all for a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from goldspine.llm.exchange import PACKED, digit, pack, release_memory, unpack
from goldspine.llm.keys import FP, ID, TEXT, buckets, keyed, public_id, small_batches, text_bytes
from goldspine.llm.sketch import PARTIAL, partial, slots, total
from goldspine.llm.tokens import U64, Spans, chunks, mix, pieces
from goldspine.sinks.staging import stage

WIDTH = 100
GRAM = 24
#: A run's suffixes are as many as fit beside its gram, at most.
_SPREAD = WIDTH - GRAM + 1
_BYTES = WIDTH + _SPREAD - 1
#: Runs of one gram that meet in one task; commoner grams are sent suffix by suffix.
MEET = 256
#: Grams are counted by so many bits of their hash.
COUNTER_BITS = 20

_PLACE_BITS = 40
_START = (1 << _PLACE_BITS) - 1
_VARIANT = (1 << 23) - 1
_POSITION_BITS = U64(32)

#: A run of suffixes: gram, hash of all its bytes, document, where it starts, and how many follow the first.
_RUN = np.dtype([("gram", "u8"), ("all", "u8"), ("id", "i8"), ("place", "i8"), ("more", "u1")])
#: In place of a run: its task has sent runs of this gram with other bytes on their way.
_DIVERSE = 255
_TEXT = np.dtype([("gram", "u8"), ("id", "i8"), ("place", "i8"), ("more", "u1"), ("bytes", "u1", _BYTES)])
_SUFFIX = np.dtype([("hi", "u8"), ("lo", "u8"), ("id", "i8"), ("place", "i8")])
RUNS, REPEATED, UNCLEAR, TEXTS, SUFFIXES = range(5)


def _place(fp: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Where a run starts, with bits of the text's hash that keep texts of one id apart."""
    return (fp & _VARIANT) << _PLACE_BITS | start


def _home(id_: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the document."""
    return digit(mix(id_.view(U64) ^ mix((place >> _PLACE_BITS).view(U64))), n)


def _runs(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(data)
    if n < WIDTH:
        return np.zeros(0, _RUN)
    spans = Spans(data)
    grams = spans.sliding(GRAM)
    # The minimum of each window, and where it is: of equal ones, the first.
    low = (grams >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(grams), dtype=U64)
    width = 1
    while 2 * width <= _SPREAD:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    starts = n - WIDTH + 1
    low = np.minimum(low[:starts], low[_SPREAD - width : _SPREAD - width + starts])
    at = (low & U64((1 << 32) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    inside = np.flatnonzero(row[:starts] == row[WIDTH - 1 :])
    if not len(inside):
        return np.zeros(0, _RUN)
    at, owner = at[inside], row[inside]
    begins = _first_of(at, owner)
    first = inside[begins]
    last = inside[np.append(np.flatnonzero(begins)[1:], len(inside)) - 1]
    at, owner = at[begins], owner[begins]
    out = np.empty(len(first), _RUN)
    out["gram"] = grams[at]
    out["all"] = spans.hash(first, last + WIDTH) ^ mix((at - first).astype(U64))
    out["id"] = part.column(ID).to_numpy()[owner]
    out["place"] = _place(part.column(FP).to_numpy()[owner], first - offsets[owner])
    out["more"] = last - first
    return out


def _first_of(*keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for key in keys:
        out[1:] |= key[1:] != key[:-1]
    return out


def _settle(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs, in any order: those alone or first with their gram's only bytes, repeats, and first ones of several bytes."""
    if not len(runs):
        return runs, runs, runs
    runs = runs[np.argsort(runs["gram"])]
    starts = np.flatnonzero(_first_of(runs["gram"]))
    sizes = np.diff(np.append(starts, len(runs)))
    many = np.repeat(sizes > 1, sizes)
    alone, runs = runs[~many], runs[many]
    if not len(runs):
        return alone, runs, runs
    runs = runs[np.lexsort((runs["place"] & _START, runs["id"], runs["all"], runs["gram"]))]
    first = _first_of(runs["gram"], runs["all"])
    diverse = runs["more"] == _DIVERSE
    # Another row of the same id and start (a repeated row) is as early as the first.
    head = runs[np.flatnonzero(first)[np.cumsum(first) - 1]]
    repeated = ((runs["id"] != head["id"]) | ((runs["place"] ^ head["place"]) & _START != 0)) & ~diverse
    groups = np.cumsum(_first_of(runs["gram"])) - 1
    several = (np.bincount(groups, first) > 1)[groups]
    alone = np.concatenate([alone, runs[first & ~several]])
    return alone, runs[repeated], runs[first & several & ~diverse]


def _first_pass(n: int):
    """Runs to the bucket of their gram; what one task can tell already goes to its document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, TEXT):
            found = [_runs(part, data, offsets) for part, data, offsets in chunks([batch], TEXT)]
            alone, repeated, unclear = _settle(np.concatenate(found) if found else np.zeros(0, _RUN))
            others = unclear[_first_of(unclear["gram"])].copy()
            others["more"], others["all"] = _DIVERSE, 0
            sent = np.concatenate([alone, others])
            if len(sent):
                yield pack(sent, digit(sent["gram"], n), RUNS)
            for kind, rows in ((REPEATED, repeated), (UNCLEAR, unclear)):
                if len(rows):
                    yield pack(rows, _home(rows["id"], rows["place"], n), kind)
        release_memory()

    return run


def _second_pass(n: int):
    def run(table: pa.Table) -> pa.Table:
        release_memory()
        out = []
        _, repeated, unclear = _settle(unpack(table, _RUN, RUNS))
        for kind, rows in ((REPEATED, repeated), (UNCLEAR, unclear)):
            rows = np.concatenate([rows, unpack(table, _RUN, kind)])
            if len(rows):
                out.append(pack(rows, _home(rows["id"], rows["place"], n), kind))
        return pa.Table.from_batches(out, _packed_schema())

    return run


def _packed_schema() -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many unclear runs a gram has, by the first bits of it."""
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    for batch in batches:
        np.add.at(counts, slots(unpack(batch, _RUN, UNCLEAR)["gram"], COUNTER_BITS), 1)
    yield partial(counts)


def _squeeze(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, fps = batch.column(ID).to_numpy(), batch.column(FP).to_numpy()
            packed = pa.array([squeeze.compress(x.as_buffer()) for x in batch.column(TEXT).cast(pa.large_binary())], pa.binary())
            home = pa.array(_home(ids, _place(fps, np.zeros(len(fps), np.int64)), n))
            yield pa.RecordBatch.from_arrays([home, batch.column(ID), batch.column(FP), packed], names=["bucket", ID, FP, "z"])

    return run


class _Documents:
    """A bucket's documents, found by id and variant."""

    def __init__(self, table: pa.Table):
        self.ids = table.column(ID).to_numpy()
        self.fps = table.column(FP).to_numpy()
        self.packed = table.column("z").to_pylist()
        self._by_key: dict[tuple[int, int], int] = {}
        for k, key in enumerate(zip(self.ids.tolist(), (self.fps & _VARIANT).tolist())):
            self._by_key.setdefault(key, k)
        self._open = zstandard.ZstdDecompressor()

    def bytes(self, k: int) -> np.ndarray:
        return np.frombuffer(self._open.decompress(self.packed[k]), np.uint8)

    def __getitem__(self, key: tuple[int, int]) -> np.ndarray:
        return self.bytes(self._by_key[key])


def _by_document(rows: np.ndarray) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    variant = rows["place"] >> _PLACE_BITS
    order = np.lexsort((rows["place"], variant, rows["id"]))
    rows, variant = rows[order], variant[order]
    starts = np.flatnonzero(_first_of(rows["id"], variant)) if len(rows) else np.zeros(0, np.int64)
    for start, stop in zip(starts.tolist(), np.append(starts[1:], len(rows)).tolist()):
        yield (int(rows["id"][start]), int(variant[start])), rows[start:stop]


def _suffixes(texts: np.ndarray) -> np.ndarray:
    """Hashes of the windows of runs that carry their bytes."""
    out = []
    for some in np.array_split(texts, max(1, len(texts) // 4096)):
        flat = np.ascontiguousarray(some["bytes"]).ravel()
        counts = some["more"].astype(np.int64) + 1
        row = np.repeat(np.arange(len(some)), counts)
        step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = row * _BYTES + step
        rows = np.empty(len(row), _SUFFIX)
        rows["hi"], rows["lo"] = (Spans(flat, lane).hash(start, start + WIDTH) for lane in (0, 1))
        rows["id"], rows["place"] = some["id"][row], some["place"][row] + step
        out.append(rows)
    return np.concatenate(out) if out else np.zeros(0, _SUFFIX)


def _later(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes: the first of each window, and those with an earlier one."""
    rows = rows[np.lexsort((rows["place"] & _START, rows["id"], rows["lo"], rows["hi"]))]
    first = _first_of(rows["hi"], rows["lo"])
    head = rows[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(rows) else rows
    later = (rows["id"] != head["id"]) | ((rows["place"] ^ head["place"]) & _START != 0)
    return rows[first], rows[later]


def _as_runs(rows: np.ndarray) -> np.ndarray:
    """Neighbouring suffixes of a document as runs."""
    rows = rows[np.lexsort((rows["place"], rows["id"]))]
    if not len(rows):
        return np.zeros(0, _RUN)
    begins = np.ones(len(rows), bool)
    begins[1:] = (rows["id"][1:] != rows["id"][:-1]) | (rows["place"][1:] - rows["place"][:-1] > 1)
    # At most so many that the count fits.
    since = np.arange(len(rows)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
    begins |= since % 200 == 0
    starts = np.flatnonzero(begins)
    out = np.zeros(len(starts), _RUN)
    out["id"], out["place"] = rows["id"][starts], rows["place"][starts]
    last = np.append(starts[1:], len(rows)) - 1
    out["more"] = rows["place"][last] - rows["place"][starts]
    return out


def _third_pass(n: int, common: Broadcast):
    """Unclear runs with their bytes, to the bucket of their gram, or of each suffix if the gram is common."""

    def run(documents: pa.Table, packed: pa.Table) -> pa.Table:
        release_memory()
        out = []
        unclear = unpack(packed, _RUN, UNCLEAR)
        if len(unclear):
            held = _Documents(documents)
            parts = []
            for key, rows in _by_document(unclear):
                data = held[key]
                start = rows["place"] & _START
                texts = np.zeros(len(rows), _TEXT)
                for name in ("gram", "id", "place", "more"):
                    texts[name] = rows[name]
                at = start[:, None] + np.arange(_BYTES)
                within = np.arange(_BYTES) < (rows["more"].astype(np.int64) + WIDTH)[:, None]
                texts["bytes"] = np.where(within, data[np.minimum(at, len(data) - 1)], 0)
                parts.append(texts)
            texts = np.concatenate(parts)
            often = common.value[slots(texts["gram"], COUNTER_BITS)]
            rare = texts[~often]
            if len(rare):
                out.append(pack(rare, digit(rare["gram"], n), TEXTS))
            first, later = _later(_suffixes(texts[often]))
            if len(first):
                out.append(pack(first, digit(first["hi"], n), SUFFIXES))
            runs = _as_runs(later)
            if len(runs):
                out.append(pack(runs, digit(mix(runs["id"].view(U64)), n), REPEATED))
        return pa.Table.from_batches(out, _packed_schema())

    return run


def _last_pass(n: int):
    def run(table: pa.Table) -> pa.Table:
        release_memory()
        found = [unpack(table, _RUN, REPEATED)]
        texts = unpack(table, _TEXT, TEXTS)
        # By gram, some at a time: equal windows have equal grams.
        texts = texts[np.argsort(texts["gram"], kind="stable")]
        edges = np.flatnonzero(_first_of(texts["gram"])) if len(texts) else np.zeros(0, np.int64)
        cuts = [edges[np.searchsorted(edges, k)] for k in range(8192, len(texts), 8192) if np.searchsorted(edges, k) < len(edges)]
        for some in np.split(texts, np.unique(cuts).astype(np.int64)):
            found.append(_as_runs(_later(_suffixes(some))[1]))
        found.append(_as_runs(_later(unpack(table, _SUFFIX, SUFFIXES))[1]))
        rows = np.concatenate(found)
        out = [pack(rows, _home(rows["id"], rows["place"], n), REPEATED)] if len(rows) else []
        return pa.Table.from_batches(out, _packed_schema())

    return run


_KEPT = f"{ID} long, {FP} long, n_bytes long, spans array<struct<s:long,e:long>>, kept binary"
_SPAN = pa.struct([("s", pa.int64()), ("e", pa.int64())])
_KEPT_TYPES = pa.schema([(ID, pa.int64()), (FP, pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(_SPAN)), ("kept", pa.binary())])


def _cut(documents: pa.Table, packed: pa.Table) -> pa.Table:
    release_memory()
    held = _Documents(documents)
    repeated = dict(_by_document(unpack(packed, _RUN, REPEATED)))
    lengths, starts, ends, counts, kept = [], [], [], [0], []
    for k, key in enumerate(zip(held.ids.tolist(), (held.fps & _VARIANT).tolist())):
        data = held.bytes(k)
        lengths.append(len(data))
        rows = repeated.get(key)
        if rows is None:
            counts.append(counts[-1])
            kept.append(data.tobytes())
            continue
        first = rows["place"] & _START
        marks = np.zeros(len(data) + 1, np.int64)
        np.add.at(marks, first, 1)
        np.add.at(marks, first + rows["more"] + WIDTH, -1)
        gone = np.cumsum(marks[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        starts.append(edges[0::2])
        ends.append(edges[1::2])
        counts.append(counts[-1] + len(edges) // 2)
        kept.append(data[~gone].tobytes())
    none = [np.zeros(0, np.int64)]
    spans = pa.StructArray.from_arrays([pa.array(np.concatenate(starts or none)), pa.array(np.concatenate(ends or none))], fields=list(_SPAN))
    return pa.Table.from_arrays(
        [pa.array(held.ids), pa.array(held.fps), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), spans), pa.array(kept, pa.binary())],
        schema=_KEPT_TYPES,
    )


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id, _fp, n_bytes, spans, kept`` for each row: removed byte ranges and the bytes that stay.

    A byte goes if a string of ``WIDTH`` bytes over it also starts earlier: in a
    smaller id, or further ahead in the same text. Strings do not cross texts
    and are judged on the input. Null and empty texts have no bytes, a null id
    is the smallest. Rows that share an id compare by their start alone: equal
    starts are equally early, so a repeated row is cut like its twin.

    Texts travel compressed, twice: to the unclear runs and to all removed
    ranges. A gram that is far commoner than others (by counters of fixed
    number) is not gathered in one task; its suffixes are sent one by one, to
    the bucket of their own hash, once from each bucket of documents.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = keyed(docs, id_column, text_column)
    n = buckets(spark, text_bytes(rows))
    second = stage(
        rows.mapInArrow(_first_pass(n), PACKED).groupBy("bucket").applyInArrow(_second_pass(n), PACKED), "repeats"
    )
    weights = total(second.where(F.col("kind") == UNCLEAR).mapInArrow(_weigh, PARTIAL), lambda counts: counts)
    common = spark.sparkContext.broadcast(weights > max(MEET, 8 * weights.mean()) if len(weights) else np.zeros(1 << COUNTER_BITS, bool))
    texts = rows.mapInArrow(_squeeze(n), f"bucket int, {ID} long, {FP} long, z binary")
    third = (
        texts.groupBy("bucket").cogroup(second.where(F.col("kind") == UNCLEAR).groupBy("bucket")).applyInArrow(_third_pass(n, common), PACKED)
        .groupBy("bucket").applyInArrow(_last_pass(n), PACKED)
    )
    repeated = second.where(F.col("kind") == REPEATED).unionByName(third)
    return texts.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(_cut, _KEPT)


def summary(docs: DataFrame) -> DataFrame:
    done = remove_repeats(docs)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return done.select(
        public_id("doc_id"), "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
