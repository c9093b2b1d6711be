"""What changed between consecutive full snapshots.

Method: invertible Bloom lookup tables.  Records are dealt to hash buckets by key; in each bucket every live
record of a snapshot goes into three cells of that snapshot's table, each cell keeping a count and the XOR of key
hashes, value digests and checks.  Subtracting the tables of two snapshots cancels what they share,
and peeling cells that hold one record gives the differing pairs of key hash and digest.  A table's size follows
an estimate of the difference (from the records whose hash falls in a small share of its range); a bucket that doesn't
peel empty, or yields a pair that no record of the bucket confirms, gets a larger table until all do.

The only shuffle is the one that brings the rows of a key together, after combination on the map side: it deals
the keys to buckets as well, so tables are built, subtracted, peeled, verified against the bucket's own records and
classified where the records lie, and no cell or finding crosses the network.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys of one bucket, about; one in so many of them estimates the difference; growth of a failed table.
BUCKET, SAMPLE, GROWTH = 2000, 16, 2
#: Cells for each record of the estimated difference, and the fewest cells of one of a table's three parts.
CELLS, LEAST_THIRD = 1.6, 8
#: Snapshots compared in one pass over the table; a longer history takes several, each reading its own snapshots.
PASS = 16
_HASHES, _CHECK = 3, 77


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each combination of ``keys``: the largest by ``order`` (nulls lowest), ties by the other columns.

    Columns keep their names and order.  Aggregates with map-side combination instead of a window,
    so no key's rows are held together.
    """
    rest = [c for c in rows.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in rows.columns])


_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _fmix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_P2)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(_P3)
    return h ^ (h >> np.uint64(32))


def hash_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """xxhash64 of 8-byte values as Spark computes it."""
    h = seed + np.uint64(_P5) + np.uint64(8)
    h = h ^ (_rotl(x * np.uint64(_P2), 31) * np.uint64(_P1))
    h = _rotl(h, 27) * np.uint64(_P1) + np.uint64(_P4)
    return _fmix(h)


def hash_int(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """xxhash64 of 4-byte values as Spark computes it."""
    h = seed + np.uint64(_P5) + np.uint64(4)
    h = h ^ ((x & np.uint64(0xFFFFFFFF)) * np.uint64(_P1))
    h = _rotl(h, 23) * np.uint64(_P2) + np.uint64(_P3)
    return _fmix(h)


def _u(x) -> np.ndarray:
    return np.asarray(x, np.int64).view(np.uint64)


def _seed(n: int) -> np.ndarray:
    return np.full(n, 42, np.uint64)


def _salted(keys: np.ndarray, values: np.ndarray, salt: int) -> np.ndarray:
    n = len(keys)
    return hash_int(np.full(n, salt, np.uint64), hash_long(values, hash_long(keys, _seed(n))))


def _places(keys: np.ndarray, values: np.ndarray, third: int) -> np.ndarray:
    return np.stack([i * third + np.mod(_salted(keys, values, i).view(np.int64), third) for i in range(_HASHES)], 1)


def peel(cell: np.ndarray, n: np.ndarray, keys: np.ndarray, values: np.ndarray, checks: np.ndarray, third: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Empty one subtracted table: differing keys, their digests and signs, and whether nothing is left.

    Rounds take all cells that hold one record at once; a record met in several cells is taken once.
    """
    size = _HASHES * third
    count = np.zeros(size, np.int64)
    k, v, c = (np.zeros(size, np.uint64) for _ in range(3))
    count[cell], k[cell], v[cell], c[cell] = n, keys, values, checks
    out_k, out_v, out_s = [], [], []
    for _ in range(size + 1):
        one = np.flatnonzero(np.abs(count) == 1)
        one = one[_salted(k[one], v[one], _CHECK) == c[one]]
        if not len(one):
            break
        _, first = np.unique(c[one], return_index=True)  # a check stands for its key and digest
        one = one[first]
        key, value, sign = k[one].copy(), v[one].copy(), count[one].copy()
        check = c[one].copy()
        at = _places(key, value, third)
        true = (at == one[:, None]).any(1)  # a record found in a cell it can't be in is none
        if not true.any():
            break
        key, value, sign, check, at = key[true], value[true], sign[true], check[true], at[true]
        for i in range(_HASHES):
            np.subtract.at(count, at[:, i], sign)
            np.bitwise_xor.at(k, at[:, i], key)
            np.bitwise_xor.at(v, at[:, i], value)
            np.bitwise_xor.at(c, at[:, i], check)
        out_k.append(key)
        out_v.append(value)
        out_s.append(sign)
    whole = not (count.any() or k.any() or v.any() or c.any())
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(out_k, np.uint64), join(out_v, np.uint64), join(out_s, np.int64), whole


class Table:
    """The table of one snapshot's records in one bucket."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, third: int) -> None:
        size = _HASHES * third
        self.third = third
        self.count = np.zeros(size, np.int64)
        self.keys, self.values, self.checks = (np.zeros(size, np.uint64) for _ in range(3))
        if len(keys):
            check = _salted(keys, values, _CHECK)
            for at in _places(keys, values, third).T:
                self.count += np.bincount(at, minlength=size)
                np.bitwise_xor.at(self.keys, at, keys)
                np.bitwise_xor.at(self.values, at, values)
                np.bitwise_xor.at(self.checks, at, check)

    def less(self, other: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """What this table holds beyond the other (sign +1) and the other beyond this (-1), peeled; and whether nothing is left."""
        cell = np.arange(len(self.count))
        return peel(cell, self.count - other.count, self.keys ^ other.keys, self.values ^ other.values, self.checks ^ other.checks, self.third)


def estimated(keys: np.ndarray, before: tuple[np.ndarray, np.ndarray], after: tuple[np.ndarray, np.ndarray]) -> int:
    """About how many records differ, from the keys whose hash falls in a SAMPLE-th of its range; before, after: (live, value) of each key."""
    at = np.flatnonzero(keys % np.uint64(SAMPLE) == 0)
    a, b = before[0][at], after[0][at]
    both = a & b
    return SAMPLE * int((a ^ b).sum() + 2 * (both & (before[1][at] != after[1][at])).sum())


def bucket_changes(keys: np.ndarray, states: list[tuple[np.ndarray, np.ndarray]], cells: float = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each snapshot after the first: (places in ``keys``, 0 added, 1 removed, 2 changed) against the one before.

    keys: distinct key hashes; states: for every snapshot (live, value digest) of each key.
    """
    order = np.argsort(keys)
    ranked = keys[order]
    out = []
    tables: dict[tuple[int, int], Table] = {}

    def table(k: int, third: int) -> Table:
        if (k, third) not in tables:
            live, value = states[k]
            tables[k, third] = Table(keys[live], value[live], third)
        return tables[k, third]

    guesses = [estimated(keys, a, b) for a, b in zip(states[:-1], states[1:])]
    start = max(LEAST_THIRD, int(max(guesses, default=0) * cells) // _HASHES + 1)
    for k in range(1, len(states)):
        third = start
        while True:
            key, value, sign, whole = table(k, third).less(table(k - 1, third))
            at = np.minimum(np.searchsorted(ranked, key), max(len(ranked) - 1, 0))
            place = order[at] if len(ranked) else at
            # a recovered pair is right only where the snapshot's own record confirms it
            if whole and len(key):
                new, old = states[k], states[k - 1]
                live = np.where(sign > 0, new[0][place], old[0][place])
                own = np.where(sign > 0, new[1][place], old[1][place])
                whole = bool(((ranked[at] == key) & live & (own == value)).all())
            if whole:
                break
            third *= GROWTH
        found, first, many = np.unique(place, return_index=True, return_counts=True)
        out.append((found, np.where(many > 1, 2, np.where(sign[first] > 0, 0, 1)) if len(found) else np.zeros(0, np.int64)))
    return out


def _compared(numbers: list[int], bucket: int) -> object:
    kinds = np.array(["added", "removed", "changed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or len(numbers) < 2:
                continue
            keys = _u(batch.column("key").to_numpy())
            states = [(batch.column(f"live{k}").to_numpy(zero_copy_only=False).astype(bool), _u(batch.column(f"value{k}").to_numpy())) for k in range(len(numbers))]
            deal = (_fmix(keys) % np.uint64(-(-batch.num_rows // bucket))).astype(np.int64)
            _, index, many = np.unique(keys, return_index=True, return_counts=True)
            shared = np.ones(len(keys), bool)
            shared[index[many == 1]] = False
            at, snapshot, change = [], [], []
            # keys of one hash can't be told apart in a table: compared as they are
            same = np.flatnonzero(shared)
            groups = [np.flatnonzero((deal == g) & ~shared) for g in range(int(deal.max()) + 1)]
            for own, changes in [*((g, bucket_changes(keys[g], [(a[g], v[g]) for a, v in states])) for g in groups), (same, _plain([(a[same], v[same]) for a, v in states]))]:
                for number, (place, kind) in zip(numbers[1:], changes):
                    at.append(own[place])
                    snapshot.append(np.full(len(place), number, np.int32))
                    change.append(kind)
            rows = np.concatenate(at)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), pa.array(np.concatenate(snapshot)), pa.array(kinds[np.concatenate(change).astype(np.int64)], pa.string())], names=["id", "snapshot", "change"])

    return run


def _plain(states: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for (a, v), (b, w) in zip(states[:-1], states[1:]):
        kind = np.where(a & b, np.where(v != w, 2, -1), np.where(b, 0, np.where(a, 1, -1)))
        out.append((np.flatnonzero(kind >= 0), kind[kind >= 0]))
    return out


def snapshot_changes(rows: DataFrame, key: str, snapshot: str, delivered: str, value: Column, live: Column, bucket: int = BUCKET) -> DataFrame:
    """Records added, removed or changed between each snapshot and the one delivered before it (the next smaller number).

    rows: any columns.  Among rows of one key in one snapshot the one with the latest ``delivered``
    counts (a null is earliest; ties: the largest by live, then value).  Rows without key or snapshot
    are left out.  ``value`` may be null: null equals null and differs from any value.  Returns
    (id, snapshot, change); an empty table or a single snapshot yields no row.
    """
    known = sorted(r[0] for r in rows.select(F.col(snapshot).cast("int").alias("k")).filter("k is not null").distinct().collect())  # one small number for each whole copy of the table
    slim = rows.select(F.col(key).alias("id"), F.col(snapshot).cast("int").alias("snapshot"), F.col(delivered).alias("delivered"), F.coalesce(live, F.lit(False)).alias("live"), F.when(value.isNull(), F.lit(0)).otherwise(F.xxhash64(value)).alias("value")).filter("id is not null and snapshot is not null")
    out = None
    for first in range(0, max(1, len(known) - 1), PASS - 1):
        numbers = known[first : first + PASS]
        state = F.struct("delivered", "live", "value")
        last = slim.filter(F.col("snapshot").isin(numbers)).groupBy("id").agg(*[F.max(F.when(F.col("snapshot") == n, state)).alias(f"s{k}") for k, n in enumerate(numbers)]) if numbers else slim.select("id").limit(0)
        laid = last.select("id", F.xxhash64("id").alias("key"), *[x for k in range(len(numbers)) for x in (F.coalesce(F.col(f"s{k}.live"), F.lit(False)).alias(f"live{k}"), F.when(F.col(f"s{k}.live"), F.col(f"s{k}.value")).otherwise(F.lit(0).cast("bigint")).alias(f"value{k}"))])
        found = laid.mapInArrow(_compared(numbers, bucket), f"id {slim.schema['id'].dataType.simpleString()}, snapshot int, change string")
        out = found if out is None else out.unionByName(found)
    return out
