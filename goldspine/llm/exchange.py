"""Shuffles of many small rows as a few packed ones.

Numpy rows go to a group by a digit of their hash; a task packs what it has
for a group into one binary value, Spark shuffles these by group, and a group
is handled at once in numpy. Callers reduce equal keys within a task first, so
that a key of any weight brings a row or so from each task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

PACKED = "bucket int, kind int, payload binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])


def release_memory() -> None:
    """Hand back what earlier groups have used: workers live on, and their allocators keep freed memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def digit(hashes: np.ndarray, n: int) -> np.ndarray:
    """The group of each hash, of ``n``: from its upper half, evenly."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def pack(rows: np.ndarray, groups: np.ndarray, kind: int = 0) -> pa.RecordBatch:
    order = np.argsort(groups, kind="stable")
    groups, rows = groups[order], rows[order]
    present, counts = np.unique(groups, return_counts=True)
    offsets = np.zeros(len(present) + 1, np.int32)
    np.cumsum(counts * rows.dtype.itemsize, out=offsets[1:])
    payload = pa.Array.from_buffers(pa.binary(), len(present), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])
    kinds = pa.array(np.full(len(present), kind, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), kinds, payload], schema=_SCHEMA)


def unpack(table: pa.Table | pa.RecordBatch, dtype: np.dtype, kind: int = 0) -> np.ndarray:
    """All rows of a kind, in no particular order."""
    batches: Iterable[pa.RecordBatch] = table.to_batches() if isinstance(table, pa.Table) else [table]
    parts = []
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        payload = batch.column("payload").cast(pa.large_binary())
        offsets = np.frombuffer(payload.buffers()[1], np.int64)[payload.offset : payload.offset + len(payload) + 1]
        data = np.frombuffer(payload.buffers()[2], np.uint8) if payload.buffers()[2] else np.zeros(0, np.uint8)
        if (kinds == kind).all():
            parts.append(data[offsets[0] : offsets[-1]])
        else:
            parts += [data[offsets[i] : offsets[i + 1]] for i in np.flatnonzero(kinds == kind)]
    return np.concatenate(parts).view(dtype) if parts else np.zeros(0, dtype)
