"""Counters of a fixed number, added up over all tasks.

What reaches the driver, and is broadcast from it, has one size for any corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_PARTS = 64
PARTIAL = "part int, counts binary"
_PLACED = f"{PARTIAL}, place int"
#: Rows of a part that one task adds up, and how often; then come all that are left.
_FAN, _LEVELS = 64, 2
#: A task counts no further; the sum over tasks does.
_MOST = np.iinfo(np.uint16).max


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The counter of each hash, of two to the power of ``bits``."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def partial(counts: np.ndarray) -> pa.RecordBatch:
    """A task's counters, in rows of a part of them each."""
    rows = np.minimum(counts, _MOST).astype(np.uint16).reshape(_PARTS, -1)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(_PARTS, dtype=np.int32)), pa.array([r.tobytes() for r in rows], pa.binary())], names=["part", "counts"]
    )


def half_powers(counts: np.ndarray) -> np.ndarray:
    """The order of magnitude, in steps of half a power of two, as a byte."""
    return np.rint(2 * np.log2(counts + 1)).astype(np.uint8)


def _adder(kind: np.dtype, of: Callable[[np.ndarray], np.ndarray] | None = None):
    """The sum of a group's rows, a batch of them at a time, or a function of it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, part, place = None, None, None
        for batch in batches:
            for some in batch.column("counts"):
                found = np.frombuffer(some.as_buffer(), kind)
                counts = found.astype(np.int64) if counts is None else counts + found
            part, place = batch.column("part")[0].as_py(), batch.column("place")[0].as_py()
        data = (counts if of is None else of(counts)).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([data], pa.binary()), pa.array([place], pa.int32())], names=["part", "counts", "place"]
        )

    return add


def total(partials: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """A function, element by element, of the sum of what tasks have counted, from rows of ``PARTIAL``.

    Sums go up a tree of tasks, ``_FAN`` rows to one, so no task gathers a row
    from every other; above it a row stands for ``_FAN ** _LEVELS`` tasks.
    """
    rows, kind = partials.withColumn("place", F.spark_partition_id()), np.dtype(np.uint16)
    for _ in range(_LEVELS):
        rows = rows.withColumn("place", F.floor(F.col("place") / _FAN).cast("int"))
        rows = rows.groupBy("part", "place").applyInArrow(_adder(kind), _PLACED)
        kind = np.dtype(np.int64)
    top = rows.withColumn("place", F.lit(0)).groupBy("part", "place").applyInArrow(_adder(kind, of), _PLACED)
    found = sorted((part, counts) for part, counts, _ in top.collect())
    kind = of(np.zeros(1, np.int64)).dtype
    return np.concatenate([np.frombuffer(counts, kind) for _, counts in found]) if found else np.zeros(0, kind)
