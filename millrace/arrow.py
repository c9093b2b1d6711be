"""Helpers for operators that run over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def strings(column: pa.Array | pa.ChunkedArray) -> list[str | None]:
    return column.to_pylist()


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed bigint."""
    return np.ascontiguousarray(x).view(np.int64)


def slices(batches: Iterable[pa.RecordBatch], column: str, room: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the strings of one column take about ``room`` bytes at most (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        sizes = np.fromiter((len(x) if x is not None else 0 for x in (v.as_py() for v in batch.column(column))), np.int64, n) if batch.nbytes > room else None
        if sizes is None:
            yield batch
            continue
        ends = np.cumsum(sizes)
        start = 0
        while start < n:
            limit = (ends[start - 1] if start else 0) + room
            stop = max(start + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys from batches sorted by them; a run is held in memory as a whole."""
    held: list[pa.RecordBatch] = []
    key: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            col = batch.column(k)
            if col.null_count or not (pa.types.is_integer(col.type) or pa.types.is_floating(col.type)):
                vals = np.array(col.to_pylist(), dtype=object)
            else:
                vals = col.to_numpy(zero_copy_only=False)
            change[1:] |= vals[1:] != vals[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:]):
            now = tuple(batch.column(k)[a].as_py() for k in keys)
            if held and now != key:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def spread(df):
    """The same rows in at least as many partitions as there are cores.

    A table in one small file comes as one partition, and what Python does to it would run in one task; larger
    tables come in enough partitions and are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, MOST_SPREAD) else df


#: Partitions below which a table may be spread.
MOST_SPREAD = 64
