"""Rows of a large table whose key is among others, without moving the large table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are sent to every worker as they are (about 16 bytes each), at most.
MOST_SENT = 1_000_000
#: Bits to a key of a Bloom filter, and the largest filter: 2**LARGEST bits (64 MiB), which serves 40 million keys; beyond, nothing is filtered.
BITS_PER_KEY, LARGEST, HASHES = 12, 29, 4


def bits_for(keys: int) -> int:
    """The size of a filter for so many keys, as a power of two."""
    return max(16, (keys * BITS_PER_KEY - 1).bit_length())


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each 64-bit hash, one row a hash."""
    h = h.view(np.uint64)
    one, two = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return np.stack([(one + np.uint64(k) * two) & np.uint64((1 << bits) - 1) for k in range(HASHES)], 1).astype(np.int64)


def words(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of a column of hashes; at most 2**bits / 64 rows of set words reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << (bits - 6), np.int64)
        for batch in batches:
            at = places(batch.column(0).to_numpy(), bits).ravel()
            np.bitwise_or.at(seen, at >> 6, np.left_shift(np.int64(1), (at & 63)))
        hit = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(seen[hit])], names=["word", "bits"])

    rows = hashes.mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    full = np.zeros(1 << (bits - 6), np.int64)
    full[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return full


def held(filter_words: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    at = places(h, bits)
    return ((filter_words[at >> 6] >> (at & 63)) & 1).all(axis=1)


def _passing(sent, bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = held(sent.value, batch.column(batch.num_columns - 1).to_numpy(), bits)
                yield batch.filter(pa.array(keep)).select(batch.schema.names[:-1])

    return run


def narrowed(rows: DataFrame, key: str, keys: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """The rows whose ``key`` is in ``keys``, or a superset of them: who needs exactly those joins afterwards.

    keys: a table with a column of that name, none of whose values is repeated; it is counted.  Up to ``most`` keys are
    sent as they are; more as a Bloom filter whose size follows their number.
    """
    n = keys.count()
    if n <= most:
        return rows.join(F.broadcast(keys.select(key)), key, "left_semi")
    bits = bits_for(n)
    if bits > LARGEST:
        return rows
    sent = rows.sparkSession.sparkContext.broadcast(words(keys.select(F.xxhash64(key).alias("h")), bits))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.withColumn("_hash", F.xxhash64(key)).mapInArrow(_passing(sent, bits), schema)
