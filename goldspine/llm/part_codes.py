"""Vector code compression: each part of a vector becomes the number of its nearest codebook entry.

Codebooks come from Ball k-means. An entry and the parts assigned to it are a
ball. Its radius says which other entries can take any of its parts: those whose
distance is at most twice the radius, its neighbours. A part nearer to its entry
than half the way to the nearest neighbour lies in the stable core and keeps its
entry unseen; any other lies in a ring that ends where half the way to the next
neighbour is longer than its distance, and is compared with the neighbours up to
there alone. Neighbours that stood still while the ball's own entry did, too, were
beaten in the last round and are left out. All of it is exact in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from goldspine.llm.keys import ID, public_id
from goldspine.llm.vectors import VALUES, cells, finite, integers, leading, packed, replaced, unpacked
from goldspine.sinks.staging import stage

_ENTRY, _LABEL = "_entry", "_label"
#: Rows of which a task compares the parts at once.
BATCH = 2048


@dataclass
class Balls:
    """One part's entries, and each ball's neighbours from near to far with the squared ways to them."""

    entries: np.ndarray
    #: All balls' neighbours one after the other, and where each ball's begin.
    neighbours: np.ndarray
    ways: np.ndarray
    begins: np.ndarray


def balls(entries: np.ndarray, radii: np.ndarray, still: np.ndarray) -> Balls:
    """``radii``: no part of a ball is further from its entry; ``still``: entries equal to those of the last assignment."""
    ways = ((entries[:, None] - entries[None]) ** 2).sum(2)
    near = ways <= 4 * radii[:, None] ** 2
    near &= ~(still[:, None] & still[None])
    np.fill_diagonal(near, False)
    found = [np.flatnonzero(row) for row in near]
    found = [row[np.argsort(ways[i, row], kind="stable")] for i, row in enumerate(found)]
    begins = np.concatenate([[0], np.cumsum([len(row) for row in found])])
    return Balls(entries, np.concatenate(found), np.concatenate([ways[i, row] for i, row in enumerate(found)]), begins)


def reassigned(x: np.ndarray, own: np.ndarray, held: Balls) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry (the lower of equally near ones), given the ball it is in, and the squared distance."""
    distance = ((x - held.entries[own]) ** 2).sum(1)
    # How many neighbours are near enough: the ring of the part, 0 in the core.
    ring = np.zeros(len(x), np.int64)
    order = np.argsort(own, kind="stable")
    present, first = np.unique(own[order], return_index=True)
    for ball, rows in zip(present, np.split(order, first[1:])):
        ways = held.ways[held.begins[ball] : held.begins[ball + 1]]
        ring[rows] = np.searchsorted(ways, 4 * distance[rows], "right")
    outer = np.flatnonzero(ring)
    if not len(outer):
        return own, distance
    counts = ring[outer]
    starts = np.cumsum(counts) - counts
    candidates = held.neighbours[np.repeat(held.begins[own[outer]] - starts, counts) + np.arange(counts.sum())]
    found = ((x[np.repeat(outer, counts)] - held.entries[candidates]) ** 2).sum(1)
    # Distance, then number, in one value: distances are below 2**56 for parts of up to 4 million components.
    n = len(held.entries)
    best = np.minimum(np.minimum.reduceat(found * n + candidates, starts), distance[outer] * n + own[outer])
    own, distance = own.copy(), distance.copy()
    own[outer], distance[outer] = best % n, best // n
    return own, distance


def _steps(batches: Iterator[pa.RecordBatch], parts: int, dims: int, held: list[Balls] | None):
    """Batches with (row, part, component), entry and distance of each part; without balls entries stay as they are."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            piece = batch.slice(start, BATCH)
            x = unpacked(piece.column(VALUES), np.int32, dims).astype(np.int64).reshape(piece.num_rows, parts, dims // parts)
            own = unpacked(piece.column(_ENTRY), np.uint8, parts).astype(np.int64)
            distance = np.zeros(own.shape, np.int64)
            for p in range(parts if held else 0):
                own[:, p], distance[:, p] = reassigned(x[:, p], own[:, p], held[p])
            yield piece, x, own, distance


def _assigning(parts: int, dims: int, held: list[Balls], last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, own, distance in _steps(batches, parts, dims, held):
            entry = packed(own.astype(np.uint8))
            if last:
                yield pa.RecordBatch.from_arrays(
                    [piece.column(ID), piece.column(_LABEL), entry, pa.array(distance.sum(1))], names=[ID, _LABEL, _ENTRY, "error"]
                )
            else:
                yield replaced(piece, **{_ENTRY: entry})

    return run


def _measuring(parts: int, dims: int, books: np.ndarray):
    """Of each part and entry: sums of components, count (both by field), and the largest distance to the entry."""
    width, n = dims // parts, books.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, most = np.zeros((parts * n, width + 1), np.int64), np.zeros(parts * n, np.int64)
        for _, x, own, _ in _steps(batches, parts, dims, None):
            cell = (own + np.arange(parts) * n).ravel()
            flat = x.reshape(-1, width)
            distance = ((flat - books.reshape(-1, width)[cell]) ** 2).sum(1)
            order = np.argsort(cell, kind="stable")
            used, first = np.unique(cell[order], return_index=True)
            sums[used, :width] += np.add.reduceat(flat[order], first, axis=0)
            sums[:, width] += np.bincount(cell, minlength=parts * n)
            most[used] = np.maximum(most[used], np.maximum.reduceat(distance[order], first))
        used = np.flatnonzero(sums[:, width])
        columns = [
            pa.array(np.repeat(used, width + 1), pa.int32()), pa.array(np.tile(np.arange(width + 1), len(used)), pa.int32()),
            pa.array(sums[used].ravel()), pa.array(np.repeat(most[used], width + 1)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "field", "value", "most"])

    return run


def _ceil_root(x: int) -> int:
    return isqrt(x - 1) + 1 if x > 0 else 0


_roots = np.vectorize(_ceil_root, otypes=[np.int64])


def usual_length(rows: DataFrame, vector_column: str, parts: int) -> int:
    """The commonest length of finite vectors that can be cut into parts; the larger of equally common ones, 0 of none."""
    size = F.size(f"`{vector_column}`")
    fitting = rows.where(finite(f"`{vector_column}`") & (size > 0) & (size % parts == 0))
    counts = fitting.groupBy(size.alias("n")).agg(F.count("*").alias("rows"))
    first = counts.orderBy(F.desc("rows"), F.desc("n")).first()
    return first.n if first else 0


def compress(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> tuple[DataFrame, np.ndarray]:
    """``_id, _label, _entry, error`` of every vector, staged, and the codebooks (part, entry, component).

    ``_entry`` holds a byte for each part, ``error`` the squared distances summed
    over the parts. Null vectors and those with a null or non-finite component are
    left out, and so are vectors of another length than the commonest that can be
    cut into ``parts``. Codebooks start as the parts of the ``entries`` (at most
    256) smallest ids, a null id first, equal ids by components; of fewer vectors
    they are shorter, and of an empty table empty. Repeated rows are as many
    vectors. Other columns are not looked at.

    A round writes each vector's entries beside it and reads them once more for
    sums and radii; a task sends a row for each component of each entry, and the
    driver holds as many.
    """
    dims = usual_length(rows, vector_column, parts)
    if not dims:
        rows, dims = rows.limit(0), parts
    label = F.col(f"`{label_column}`").alias(_LABEL)
    state = integers(rows, id_column, vector_column, scale, dims, "code-vectors", label)
    starts, width = leading(state, [F.col(ID)], entries, dims), dims // parts
    books = starts.reshape(len(starts), parts, width).transpose(1, 0, 2).copy()
    kind = rows.schema[label_column].dataType.simpleString()
    if not len(starts):
        none = state.select(ID, _LABEL, F.lit(b"").alias(_ENTRY), F.lit(0).cast("long").alias("error"))
        return none, books
    # At first all parts are in the ball of entry 0, which every entry is a neighbour of.
    radii = np.zeros((parts, len(starts)), np.int64)
    radii[:, 0] = 1 << 29
    still = np.zeros((parts, len(starts)), bool)
    state = state.withColumn(_ENTRY, F.lit(bytes(parts)))
    for _ in range(rounds):
        held = [balls(books[p], radii[p], still[p]) for p in range(parts)]
        fields = f"{ID} long, {_LABEL} {kind}, {VALUES} binary, {_ENTRY} binary"
        state = stage(state.select(ID, _LABEL, VALUES, _ENTRY).mapInArrow(_assigning(parts, dims, held, False), fields), "code-entries")
        measured = state.select(VALUES, _ENTRY).mapInArrow(_measuring(parts, dims, books), "cell int, field int, value long, most long")
        # At most parts * entries * (width + 1) rows.
        found = cells(measured, F.max("most").alias("most"))
        sums, most = np.zeros((parts * len(starts), width + 1), np.int64), np.zeros(parts * len(starts), np.int64)
        for r in found:
            sums[r.cell, r.field], most[r.cell] = r.value, r.most
        used = sums[:, width] > 0
        after = books.reshape(-1, width).copy()
        after[used] = sums[used, :width] // sums[used, width:]
        shift = ((after - books.reshape(-1, width)) ** 2).sum(1)
        # The entry has moved by no more than its shift, and so the radius.
        radii = (_roots(most) + _roots(shift)).reshape(parts, -1)
        still = (shift == 0).reshape(parts, -1)
        books = after.reshape(books.shape)
    held = [balls(books[p], radii[p], still[p]) for p in range(parts)]
    done = state.mapInArrow(_assigning(parts, dims, held, True), f"{ID} long, {_LABEL} {kind}, {_ENTRY} binary, error long")
    return stage(done, "codes"), books


def restored(codes: DataFrame, books: np.ndarray, scale: int = 256) -> DataFrame:
    """``_id`` and the vector that a code stands for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = unpacked(batch.column(_ENTRY), np.uint8, len(books))
            x = np.concatenate([books[p, own[:, p]] for p in range(len(books))], 1) / scale
            offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(ID), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))], names=[ID, "vector"])

    return codes.select(ID, _ENTRY).mapInArrow(run, f"{ID} long, vector array<double>")


def summary(rows: DataFrame) -> DataFrame:
    codes, books = compress(rows)
    written = ",".join(map(str, books.ravel().tolist()))
    per_label = codes.groupBy(_LABEL).agg(F.sum("error").alias("label_error"))
    same = F.col(f"c.{_LABEL}").eqNullSafe(F.col(f"l.{_LABEL}"))
    return codes.alias("c").join(per_label.alias("l"), same).select(
        public_id("vec_id"), F.lower(F.hex(_ENTRY)).alias("code"), "error", "label_error", F.sha2(F.lit(written), 256).alias("codebooks_sha256")
    )


def _oracle(rounds: int = 2) -> str:
    """Every part against every entry; a mean is rounded down by its remainder."""
    steps = ["""
WITH finite AS (
  SELECT vec_id, embedding, label FROM embeddings
  WHERE len(embedding) > 0 AND len(embedding) % 16 = 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), usual AS (SELECT len(embedding) AS n FROM finite GROUP BY n ORDER BY count(*) DESC, n DESC LIMIT 1
), kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS FIRST, v) AS r, * FROM (
    SELECT vec_id, label, n // 16 AS w, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM finite JOIN usual ON len(embedding) = n
  )
), parts AS MATERIALIZED (
  SELECT r, p, v[p * w + 1 : p * w + w] AS x FROM kept, range(16) q(p)
), b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= 64)"""]
    for i in range(rounds + 1):
        steps.append(f""", a{i} AS MATERIALIZED (
  SELECT r, p, x, e, d FROM (
    SELECT r, p, s.x, e, list_sum(list_transform(list_zip(s.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM parts s JOIN b{i} b USING (p)
  ) QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1
)""")
        if i < rounds:
            steps.append(f""", m{i} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM (
    SELECT p, e, j, CAST(sum(y) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT p, e, generate_subscripts(x, 1) AS j, unnest(x) AS y FROM a{i}) GROUP BY p, e, j
  ) GROUP BY p, e
), b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.x, o.x) AS x FROM b{i} o LEFT JOIN m{i} m USING (p, e))""")
    steps.append(f""", coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
""")
    return "".join(steps)


ORACLE = _oracle()
