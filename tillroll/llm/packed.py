"""Exchanges of numbers in packed rows.

A task gathers numpy entries, sorts them by hash bucket and emits one row for
each bucket with the entries' bytes, so a shuffle moves few rows and no
per-row overhead.  The buckets come from the entries' own hashes and are thus
even; a task emits as soon as it holds ``FLUSH`` entries, so its memory is
bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

FLUSH = 4_000_000


class Packer:
    """Rows (bucket, one binary column for each array) of entries that ``add`` gathers."""

    def __init__(self, count: int, names: tuple[str, ...], key: str = "bucket"):
        self.count, self.names, self.key = count, names, key
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, target: np.ndarray, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(target):
            self.held.append((target, *arrays))
            self.size += len(target)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        target, *arrays = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        if self.count <= 1 << 16:
            target = target.astype(np.uint16)  # sorted by digits, in one pass
        order = np.argsort(target, kind="stable")
        at = np.append(0, np.cumsum(np.bincount(target, minlength=self.count)))
        full = np.flatnonzero(np.diff(at))
        columns = [pa.array(full.astype(np.int32))]
        for values in arrays:
            values = values[order]
            columns.append(pa.array([values[at[k] : at[k + 1]].tobytes() for k in full], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=[self.key, *self.names])


def schema(names: tuple[str, ...], key: str = "bucket") -> str:
    return f"{key} int, " + ", ".join(f"{n} binary" for n in names)


def unpack(table: pa.Table, name: str, dtype) -> np.ndarray:
    """All entries of one packed column, one after another."""
    blobs = table.column(name).to_pylist()
    return np.frombuffer(b"".join(blobs), dtype=dtype)


def packed_rows(table: pa.Table, name: str, dtype) -> np.ndarray:
    """Entries in each row of a packed column."""
    return np.array([len(x) for x in table.column(name).to_pylist()], dtype=np.int64) // np.dtype(dtype).itemsize
