"""Vectors as integers: a staged row for each, whose components are one binary value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from goldspine.llm.keys import ID, NO_ID
from goldspine.sinks.staging import stage

VALUES = "_values"
#: Integers reach this at most, so that squared distances stay within 64 bits.
LARGEST = 1 << 27


def finite(vector: str) -> Column:
    """Neither null itself nor with a null, infinite or undefined component."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def packed(values: np.ndarray) -> pa.Array:
    """A binary value for each row."""
    width = values.dtype.itemsize * values.shape[1]
    offsets = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def unpacked(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data.view(dtype).reshape(len(column), width)


def replaced(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns put in place of those of the name, or behind."""
    names = [*batch.schema.names, *[c for c in columns if c not in batch.schema.names]]
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else batch.column(c) for c in names], names=names)


def _floors(scale: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = batch.column(VALUES).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                floors = np.floor(vectors * scale)
                if np.abs(floors).max(initial=0) > LARGEST:
                    raise ValueError(f"a component times {scale} is beyond {LARGEST}")
                yield replaced(batch, **{VALUES: packed(floors.astype(np.int32))})

    return run


def integers(rows: DataFrame, id_column: str, vector_column: str, scale: int, dims: int, label: str, *more: Column) -> DataFrame:
    """``_id, _values`` (and ``more``) of the finite vectors of ``dims`` components, staged: ``floor(scale * x)``, in 32 bits.

    A null id ranks first. Components beyond ``LARGEST / scale`` end the job.
    """
    kept = rows.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias(ID), F.col(f"`{vector_column}`").cast("array<double>").alias(VALUES), *more
    ).where((F.size(VALUES) == dims) & finite(VALUES))
    fields = ", ".join(f"{f.name} {'binary' if f.name == VALUES else f.dataType.simpleString()}" for f in kept.schema)
    return stage(kept.mapInArrow(_floors(scale, dims), fields), label)


def leading(rows: DataFrame, order: list[Column], n: int, dims: int) -> np.ndarray:
    """The first ``n`` vectors in that order; equal places go by the components."""
    whole = F.col(VALUES)
    found = rows.orderBy(*order, F.hex(whole)).limit(n).select(VALUES).collect()
    return np.array([np.frombuffer(r[0], np.int32) for r in found], np.int64).reshape(-1, dims)


def cells(parts: DataFrame, *more: Column) -> list[Row]:
    """``value`` summed by ``cell`` and ``field`` over the tasks, each of which has a row for these at most."""
    return parts.groupBy("cell", "field").agg(F.sum("value").alias("value"), *more).collect()
