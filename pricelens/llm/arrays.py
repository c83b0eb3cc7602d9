"""Arrays that travel as binary columns: packing, grouping of sorted batches, and distributed sums."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

SUM_TASKS = 16
LEVEL = 5                # of the compression


def released(task: Callable) -> Callable:
    """``task`` for ``mapInArrow``; when it ends, memory that it freed goes back to the system.

    Workers live on for later tasks, and the allocators keep what was freed otherwise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):                  # another C library
            pass

    return run


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
        parts.append(a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little") + planes.tobytes())
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(parts))


def unpack(payload: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``."""
    raw = zstandard.ZstdDecompressor().decompress(payload)
    out, at = [], 0
    while at < len(raw):
        kind, n = np.dtype(raw[at:at + 4].decode().strip()), int.from_bytes(raw[at + 4:at + 12], "little")
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel() if n else np.zeros(0, kind))
        at += n * kind.itemsize
    return out


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[pa.RecordBatch]]]:
    """Runs of equal first-column values of batches sorted by it."""
    key, held = None, []
    for batch in batches:
        keys = batch.column(0).to_pylist()
        a = 0
        for b in range(1, len(keys) + 1):
            if b == len(keys) or keys[b] != keys[a]:
                if held and keys[a] != key:
                    yield key, held
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
                a = b
    if held:
        yield key, held


def by_key(rows: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Rows with equal keys side by side, ready for ``grouped``."""
    dealt = rows.repartition(tasks, key) if tasks else rows.repartition(key)
    return dealt.sortWithinPartitions(key)


def sliced(total: np.ndarray) -> pa.RecordBatch:
    """A task's array as rows ``part, payload``, one for each of the tasks that add arrays up."""
    parts = np.array_split(total, SUM_TASKS)
    return pa.RecordBatch.from_arrays([pa.array(range(SUM_TASKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                                      names=["part", "payload"])


def array_sum(rows: DataFrame, dtype: type = np.float64) -> np.ndarray:
    """Sum of the tasks' ``sliced`` arrays (of one size); the driver gets the sum alone."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in grouped(batches):
            total = np.sum([np.frombuffer(p.as_py(), dtype) for b in held for p in b.column(1)], axis=0, dtype=dtype)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             names=["part", "payload"])

    parts = by_key(rows, "part", SUM_TASKS).mapInArrow(add, "part int, payload binary").collect()
    return np.concatenate([np.frombuffer(r.payload, dtype) for r in sorted(parts, key=lambda r: r.part)] or [np.zeros(0, dtype)])
