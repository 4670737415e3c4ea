"""Benchmark decontamination by winnowing.

Of each window of ten words the least of its six hashes of five words is kept,
at its first place: the fingerprints of a text, about two for seven words. Two
equal windows keep the same one, so joining the fingerprints of documents and
items meets every shared span of a window's length. Each meeting is extended
word by word to both sides, as far as a window that holds the fingerprint can
reach, and counts if ten words in a row are equal. An item of fewer words is one
window, whose only fingerprint is the hash of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from goldspine.llm.keys import FP, ID, TEXT, keyed, public_id
from goldspine.llm.tokens import ALNUM, U64, chunks, grams, words
from goldspine.sinks.staging import stage

WINDOW, GRAM = 10, 5
#: Words of a window beside the fingerprint's: so far an extension goes to either side.
REACH = WINDOW - GRAM
SKETCH_BITS = 24
#: m: words of the fingerprint; f: its hash; at: its first word; near: 128 bits of each
#: word from REACH before it to REACH behind it (m = GRAM), or of its own words.
_HIT = "array<struct<m:int,f:bigint,at:int,near:binary>>"
_HIT_TYPE = pa.struct([("m", pa.int32()), ("f", pa.int64()), ("at", pa.int32()), ("near", pa.binary())])
_WORD = 16
#: What stands for words beyond a text's ends: never equal on the two sides.
_OUTSIDE = {False: 1, True: 2}


def _slots(prints: np.ndarray) -> np.ndarray:
    return (prints >> U64(64 - SKETCH_BITS)).astype(np.int64)


def _minima(small: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of the least gram of each window, the first of equal ones; windows lie within a text."""
    n = len(row) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    place, least = np.arange(n), small[:n].copy()
    for i in range(1, REACH + 1):
        lower = small[i : i + n] < least
        least[lower] = small[i : i + n][lower]
        place[lower] = np.flatnonzero(lower) + i
    return np.unique(place[row[:n] == row[WINDOW - 1 :]])


def _scan(sizes: tuple[int, ...], known: bytes | None, data: np.ndarray, offsets: np.ndarray):
    """Number of words of each text, and (row, m, f, at, near) of its fingerprints, by row.

    Items (``known`` is None) have those of their own length; documents those of
    all ``sizes``, of which only the ones with a bit in ``known`` can meet an item's.
    """
    items = known is None
    lanes, begins = words(data, offsets, ALNUM, 2)
    counts = np.diff(begins)
    row = np.repeat(np.arange(len(counts)), counts)
    pairs = np.stack(lanes, 1) if len(row) else np.zeros((0, 2), U64)
    bits = None if items else np.frombuffer(known, np.uint8)
    found = []
    for size in sizes:
        long = size == WINDOW
        prints = grams(lanes[0], GRAM if long else size)
        if long:
            at = _minima(prints, row)
        else:
            at = np.flatnonzero(row[: len(prints)] == row[size - 1 :]) if len(prints) else np.zeros(0, np.int64)
            if items:
                at = at[counts[row[at]] == size]
        if bits is not None:
            slots = _slots(prints[at])
            at = at[(bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1]
        if not len(at):
            continue
        reach = REACH if long else 0
        place = at[:, None] + np.arange(-reach, (GRAM if long else size) + reach)
        inside = (place >= begins[row[at]][:, None]) & (place < begins[row[at] + 1][:, None])
        near = pairs[np.clip(place, 0, len(pairs) - 1)]
        near[~inside] = _OUTSIDE[items]
        found += zip(row[at].tolist(), [GRAM if long else -size] * len(at), prints[at].view(np.int64).tolist(), (at - begins[row[at]]).tolist(), map(bytes, near))
    return counts, sorted(found, key=lambda x: x[0])


def _scanner(sizes: tuple[int, ...], known):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if known is None else known.value
        for part, data, offsets in chunks(batches, TEXT):
            counts, found = _scan(sizes, bits, data, offsets)
            row, m, f, at, near = zip(*found) if found else [()] * 5
            values = pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip((m, f, at, near), _HIT_TYPE)], fields=list(_HIT_TYPE))
            begins = np.searchsorted(np.array(row, np.int64), np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(begins), values)],
                names=[*part.schema.names[:-1], "n_words", "hits"],
            )

    return scan


def _bitmap(prints: DataFrame) -> bytes:
    """A bit for each fingerprint: at most 2**18 rows of 64 bits come to the driver."""
    slot = F.shiftrightunsigned("f", 64 - SKETCH_BITS)
    found = prints.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(f, 40) & 63 as int))")).alias("bits")
    ).toArrow()
    marks = np.zeros(1 << (SKETCH_BITS - 6), np.int64)
    marks[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return marks.tobytes()


def _words_of(near: Column, first: int, n: int) -> Column:
    return F.substring(near, 1 + first * _WORD, n * _WORD)


def _keyed_by_side(prints: DataFrame) -> DataFrame:
    """Fingerprints with the words that a meeting has in common besides: of the five words that a window
    holds beside a fingerprint, three at least stand before it or three behind it. Whole short items have none."""
    sides = F.when(F.col("m") == GRAM, F.array(
        F.struct(F.lit(0).alias("side"), _words_of(F.col("near"), REACH - 3, GRAM + 3).alias("same")),
        F.struct(F.lit(1).alias("side"), _words_of(F.col("near"), REACH, GRAM + 3).alias("same")),
    )).otherwise(F.array(F.struct(F.lit(2).alias("side"), F.col("near").alias("same"))))
    return prints.select("*", F.explode(sides).alias("_k")).select("*", "_k.*").drop("_k")


def _equal_run(order: range) -> Column:
    """How many words in that order are equal on both sides before one is not."""
    run = F.lit(len(order))
    for n, k in reversed(list(enumerate(order))):
        run = F.when(_words_of(F.col("d.near"), k, 1) != _words_of(F.col("i.near"), k, 1), F.lit(n)).otherwise(run)
    return run


def find_spans(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               item_column: str = "item_id", item_text_column: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (``_id, _fp, n_words``), shared spans (``_id, _fp, s, e, print``), and the items of each ``print``.

    A span is words ``s`` to ``e`` of a document that are also words of an item:
    ten at least, or a whole item of fewer. Words are runs of ASCII letters and
    digits and of anything beyond ASCII, with A-Z lower-cased.

    A bitmap of fixed size (2 MiB) over the items' fingerprints is broadcast, so
    that documents leave out fingerprints that meet nothing. Words are compared
    by hashes of 128 bits. An empty table of either kind gives no span.
    """
    item = F.col(f"`{item_column}`").cast("string").alias("_item")
    bench = keyed(items, item_column, item_text_column, item).select("_item", TEXT)
    owned = stage(
        bench.mapInArrow(_scanner(tuple(range(1, WINDOW + 1)), None), f"_item string, n_words long, hits {_HIT}")
        .select("_item", F.explode("hits").alias("h")).select("_item", "h.m", "h.f", "h.near")
        .select("_item", "m", "f", "near", F.xxhash64("m", "f", "near").alias("print")).distinct(),
        "bench-prints",
    )
    prints = owned.select("m", "f", "near", "print").distinct()
    # One row for each of the ten kinds of fingerprint at most.
    present = tuple(sorted(WINDOW if r[0] == GRAM else -r[0] for r in owned.select("m").distinct().collect()))
    known = docs.sparkSession.sparkContext.broadcast(_bitmap(owned.select("f")))
    scanned = stage(
        keyed(docs, id_column, text_column).select(ID, FP, TEXT)
        .mapInArrow(_scanner(present, known), f"{ID} long, {FP} long, n_words long, hits {_HIT}"),
        "doc-prints",
    )
    ours = scanned.where(F.size("hits") > 0).select(ID, FP, F.explode("hits").alias("h")).select(ID, FP, "h.*")
    met = _keyed_by_side(ours).alias("d").join(_keyed_by_side(prints).alias("i"), ["m", "f", "side", "same"])
    before, behind = _equal_run(range(REACH - 1, -1, -1)), _equal_run(range(REACH + GRAM, WINDOW + REACH))
    extended = met.select(
        ID, FP, "m", "at", "print",
        F.when(F.col("m") == GRAM, before).otherwise(0).alias("l"), F.when(F.col("m") == GRAM, behind).otherwise(0).alias("r"),
    ).where((F.col("m") < 0) | (F.col("l") + F.col("r") >= REACH))
    spans = extended.select(ID, FP, (F.col("at") - F.col("l")).alias("s"), (F.col("at") + F.abs("m") + F.col("r")).alias("e"), "print")
    return scanned.select(ID, FP, "n_words"), spans, owned.select("print", F.col("_item").alias("item"))


def decontaminate(docs: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """For each document: words, words inside benchmark windows, and the items met.

    Null and empty texts have no words and hit nothing; an item without words
    has no window; a null item is left out of the list; repeated rows of a
    document count once and each get the result; an empty table stays empty.
    """
    scanned, spans, owners = find_spans(docs, items, **columns)
    spans = stage(spans.distinct(), "shared-spans")
    ranges = F.array_sort(F.collect_set(F.struct("s", "e")))
    covered = F.aggregate(
        "_ranges",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["e"]))).alias("n"),
            F.greatest(a["e"], x["e"]).alias("e"),
        ),
        lambda a: a["n"],
    )
    hit = spans.groupBy(ID, FP).agg(ranges.alias("_ranges")).select(ID, FP, covered.cast("long").alias("n_hit"))
    # Items come in after a document's meetings with one fingerprint are one row.
    met = spans.select(ID, FP, "print").distinct().join(owners, "print").select(ID, FP, "item").distinct()
    listed = met.groupBy(ID, FP).agg(F.array_sort(F.collect_list("item")).alias("items"))
    return scanned.join(hit, [ID, FP], "left").join(listed, [ID, FP], "left").select(
        ID, FP, "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def summary(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontaminate(docs, items).select(
        public_id("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH folded AS (
  SELECT 0 AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 1, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), worded AS (
  SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM folded
), sizes AS (
  SELECT DISTINCT least(len(w), 10) AS m FROM worded WHERE side = 1 AND len(w) > 0
), starts AS (
  SELECT side, id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM worded, sizes
  WHERE len(w) >= m AND (side = 0 OR m = 10 OR len(w) = m)
), grams AS (
  SELECT side, id, m, s, array_to_string(w[s : s + m - 1], ' ') AS g FROM starts
), windows AS (
  SELECT DISTINCT id AS item_id, g FROM grams WHERE side = 1
), hits AS (
  SELECT d.id AS doc_id, d.s, d.m, b.item_id FROM grams d JOIN windows b ON b.g = d.g WHERE d.side = 0
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
)
SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM worded w LEFT JOIN covered c ON c.doc_id = w.id LEFT JOIN items i ON i.doc_id = w.id WHERE w.side = 0
"""
