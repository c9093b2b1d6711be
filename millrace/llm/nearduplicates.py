"""Near-duplicate records by SetSketch registers.

Every record's set of word n-grams is summarised by m registers.  Register i is the truncated,
exponentially spaced minimum of exponentially distributed hashes of the set: floor(1 - log_b(min)),
kept within 0..q+1, so registers of a union are the larger of both (mergeable) and two registers
agree with a probability that grows with the Jaccard similarity.  Bands of registers propose pairs;
for each proposed pair the similarity is estimated by maximum likelihood from how many registers are
larger, smaller or equal, jointly with the known set sizes; pairs whose estimate lies clearly below
the threshold are dropped and the rest verified on the n-gram sets themselves.

Records with the same n-gram set form one class and are compared once.  A bucket of any size is
handled: small ones within one pass, larger ones as pairs of blocks of bounded size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.arrow import groups, spread
from millrace.bloom import narrowed
from millrace.scratch import cut
from millrace.text import body_of

WORD = re.compile(r"[^\W_]+")
_PLAIN = re.compile(r"[a-z0-9]+")
#: Registers are spaced by powers of BASE; LIMIT is q.
BASE, LIMIT = 1.001, 65534

_MULT = (np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1))


def rows_and_bands(threshold: float, miss: float, rows: int) -> int:
    """Bands of ``rows`` registers so that a pair at the threshold shares none with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))


def ngrams(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's sequences of n lower-cased words."""
    low = text.lower()
    words = (_PLAIN if low.isascii() else WORD).findall(low)
    if len(words) < n:
        return np.zeros(0, np.uint64)
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    h = np.fromiter((known[w] for w in words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        out = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[k : len(h) - n + 1 + k]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minima(grams: np.ndarray, m: int) -> np.ndarray:
    """m least hashes of a set, as uint32; all ones where a register has no member.

    The registers come in parts of PART; a part's hash function deals each member to one register and
    gives it a value there.  The register-wise least of two sets' minima are the union's minima.
    """
    parts = -(-m // PART)
    with np.errstate(over="ignore"):
        x = grams[None, :] * _MULT[:parts, None]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
    # (register, value) in one number: the smallest of each register comes first
    x >>= np.uint64(64 - 6 - 32)
    x |= np.arange(parts, dtype=np.uint64)[:, None] << np.uint64(38)
    x = np.sort(x.ravel())
    register = x >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], register[1:] != register[:-1]]))
    least = np.full(parts * PART, 0xFFFFFFFF, np.uint32)
    least[register[first].astype(np.int64)] = x[first].astype(np.uint32)
    return least[:m]


#: Registers dealt by one hash function.
PART = 64


def registers_of(least: np.ndarray) -> np.ndarray:
    """SetSketch registers (one row for each set), as uint16, from minima.

    A register without member takes the value of the first register, in an order of its own that
    is the same for all sets, that has one; so registers of two sets still agree as their sets do.
    """
    n, m = least.shape
    least = least.copy()
    empty = least == 0xFFFFFFFF
    left_row, left_col = np.nonzero(empty & ~empty.all(1)[:, None])
    for attempt in range(1, 64 * m):
        if not len(left_row):
            break
        h = (left_col.astype(np.uint64) + np.uint64(1)) * _MULT[2048] + np.uint64(attempt) * _MULT[2049]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        source = ((h >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        full = ~empty[left_row, source]
        least[left_row[full], left_col[full]] = least[left_row[full], source[full]]
        left_row, left_col = left_row[~full], left_col[~full]
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 4294967296.0)
    return np.clip(np.floor(1 - np.log(value) / math.log(BASE)) + _OFFSET, 0, LIMIT + 1).astype(np.uint16)


def registers(grams: np.ndarray, m: int) -> np.ndarray:
    """The m registers of a set of 64-bit hashes."""
    return registers_of(minima(grams, m)[None, :])[0]


#: Moves the useful range of registers to 0..q+1: minima of 1 to 2**48 hashes fall inside.
_OFFSET = 8000


def likeliest(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs, given register comparisons and set sizes.

    With u = |A|/(|A|+|B|), v = 1-u: P(A's register larger) = p(u - v*J), P(smaller) = p(v - u*J) with
    p(x) = -log_b(1 - x(b-1)/b), and equal otherwise.  Ternary search: the log-likelihood is concave.
    """
    u = size_a / np.maximum(size_a + size_b, 1)
    v = 1 - u
    top = np.minimum(u, v) / np.maximum(np.maximum(u, v), 1e-12)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)

    def value(j: np.ndarray) -> np.ndarray:
        x, y = p(u - v * j), p(v - u * j)
        return larger * np.log(np.maximum(x, 1e-12)) + smaller * np.log(np.maximum(y, 1e-12)) + equal * np.log(np.maximum(1 - x - y, 1e-12))

    low, high = np.zeros(len(u)), top.copy()
    for _ in range(rounds):
        one, two = low + (high - low) / 3, high - (high - low) / 3
        less = value(one) < value(two)
        low, high = np.where(less, one, low), np.where(less, high, two)
    return (low + high) / 2


#: Bytes kept of a band's hash. Records meet by chance in 2**48 values seldom, and the estimate drops those that do.
KEY_BYTES = 6


def band_keys(registers: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Hashes (one row for each record) of the registers of every band; a band takes its registers from different parts."""
    n = len(registers)
    r = registers[:, : rows * bands].reshape(n, rows, bands)
    weight = _MULT[1024 : 1024 + rows * bands].reshape(bands, rows)
    h = np.full((n, bands), 0x1234567, np.uint64)
    for k in range(rows):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + r[:, k, :].astype(np.uint64) * weight[None, :, k]
    h ^= h >> np.uint64(32)
    return h & np.uint64((1 << 8 * KEY_BYTES) - 1)


def _sketched(text_of: Callable[[str | None], str], n: int, m: int, rows: int, bands: int, kept: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        at = 0
        # few records at once: their registers are 64-bit numbers for a while
        for batch in (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512)):
            ids, sets, sizes, least = [], [], [], []
            for i, raw in zip(batch.column("id").to_pylist(), batch.column("raw").to_pylist()):
                if i is None:
                    continue
                g = ngrams(text_of(raw), n)
                if len(g):
                    ids.append(i)
                    sets.append(xxhash.xxh3_128_digest(g.tobytes()))
                    sizes.append(len(g))
                    least.append(minima(g, m))
            count = len(ids)
            if not count:
                continue
            full = registers_of(np.stack(least))
            keys = band_keys(full, rows, bands).astype("<u8").view(np.uint8).reshape(count, bands, 8)[:, :, :KEY_BYTES]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(base + at + np.arange(count)), pa.array(sets, pa.binary()), pa.array(sizes, pa.int32()), pa.array([r[:kept].tobytes() for r in full], pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary())],
                names=["id", "no", "class_key", "size", "registers", "keys"],
            )
            at += count

    return run


SKETCHED = "id string, no bigint, class_key binary, size int, registers binary, keys binary"


def _banded(bands: int, without: np.ndarray) -> Callable:
    """(band, no) rows of all records but those numbered in the sorted array ``without``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no = batch.column("no").to_numpy()
            own = np.ones(len(no), bool)
            if len(without):
                own = without[np.minimum(np.searchsorted(without, no), len(without) - 1)] != no
            if not own.any():
                continue
            no = no[own]
            raw = np.frombuffer(b"".join(batch.column("keys").filter(pa.array(own)).to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
            flat = np.zeros((len(raw), 8), np.uint8)
            flat[:, :KEY_BYTES] = raw
            flat = flat.view("<i8").ravel()
            number = np.repeat(no, bands)
            for a in range(0, len(flat), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(flat[a : a + (1 << 17)]), pa.array(number[a : a + (1 << 17)])], names=["band", "no"])

    return run


#: Numbers of repeated texts that are sent to the workers at most (8 bytes each); more are left out by a join.
MOST_REPEATED = 1_000_000


#: Records that one bucket, or block of a bucket, holds at most.
BLOCK = 512


def _pairs_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the records of each bucket of at most BLOCK; rows come sorted by band, larger buckets are filtered out before.

    Buckets of equal size are expanded together; a bucket that goes on in the next batch is carried over.
    """
    rest_band, rest_no = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def expand(band: np.ndarray, no: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1], [True]]))
        size = np.diff(edge)
        for s in np.unique(size[size > 1]).tolist():
            starts = edge[:-1][size == s]
            i, j = np.triu_indices(s, 1)
            step = max(1, (1 << 17) // len(i))
            for at in range(0, len(starts), step):
                own = no[starts[at : at + step, None] + np.arange(s)]
                yield _pairs_of(own[:, i].ravel(), own[:, j].ravel())

    for batch in batches:
        if not batch.num_rows:
            continue
        band = np.concatenate([rest_band, batch.column("band").to_numpy()])
        no = np.concatenate([rest_no, batch.column("no").to_numpy()])
        cut_at = int(np.searchsorted(band, band[-1], "left"))
        if cut_at:
            yield from expand(band[:cut_at], no[:cut_at])
        rest_band, rest_no = band[cut_at:], no[cut_at:]
    if len(rest_band):
        yield from expand(rest_band, rest_no)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in groups(batches, ["band", "x", "y"]):
        block, no = t.column("block").to_numpy(), t.column("no").to_numpy()
        x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
        if x == y:
            i, j = np.triu_indices(len(no), 1)
            yield _pairs_of(no[i], no[j])
        else:
            a, b = no[block == x], no[block == y]
            yield _pairs_of(np.repeat(a, len(b)), np.tile(b, len(a)))


def proposed(sketches: DataFrame, repeated: DataFrame, bands: int, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b), a < b, of record numbers that share a band's key.

    sketches: no, keys; repeated: the numbers (no) of records whose set another record stands for.  Buckets
    larger than ``block`` leave the single pass and are joined block against block, each pair of blocks by itself.
    """
    some = repeated.limit(MOST_REPEATED + 1).toArrow().column("no").to_numpy()
    if len(some) > MOST_REPEATED:
        sketches, some = sketches.join(repeated, "no", "left_anti"), some[:0]
    banded = sketches.select("no", "keys").mapInArrow(_banded(bands, np.sort(some)), "band bigint, no bigint")
    buckets = banded.repartition("band").sortWithinPartitions("band")
    out = cut(buckets.mapInArrow(_split_large(block), "band bigint, no bigint, block int, a bigint, b bigint"), "proposed")
    pairs = out.filter("band is null").select("a", "b")
    large = out.filter("band is not null").select("band", "no", "block")
    if not large.isEmpty():
        blocks = large.groupBy("band").agg(F.max("block").alias("last"))
        joined = (
            large.join(blocks, "band")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
            .select("band", "no", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
        )
        more = joined.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y").mapInArrow(_block_pairs, "a bigint, b bigint")
        pairs = pairs.unionByName(more)
    return pairs.filter("a <> b").distinct()


def _split_large(block: int) -> Callable:
    """Pairs of small buckets (a, b); the members of larger ones as (band, no, block) rows."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    names = ["band", "no", "block", "a", "b"]

    def as_pairs(p: pa.RecordBatch) -> pa.RecordBatch:
        n = p.num_rows
        return pa.RecordBatch.from_arrays([pa.nulls(n, kinds[0]), pa.nulls(n, kinds[1]), pa.nulls(n, kinds[2]), p.column("a"), p.column("b")], names=names)

    def as_members(band: int, no: np.ndarray, start: int) -> pa.RecordBatch:
        n = len(no)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, band)), pa.array(no), pa.array(((start + np.arange(n)) // block).astype(np.int32)), pa.nulls(n, kinds[3]), pa.nulls(n, kinds[4])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_band: int | None = None  # a large bucket that is being passed on
        passed = 0
        rest: list[tuple[np.ndarray, np.ndarray]] = []

        def close(band: np.ndarray, no: np.ndarray) -> Iterator[pa.RecordBatch]:
            edge = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1], [True]]))
            size = np.diff(edge)
            for at in np.flatnonzero(size > block).tolist():
                yield as_members(int(band[edge[at]]), no[edge[at] : edge[at + 1]], 0)
            few = np.repeat(size <= block, size)
            for p in _bucket_pairs(iter([pa.RecordBatch.from_arrays([pa.array(band[few]), pa.array(no[few])], names=["band", "no"])])):
                yield as_pairs(p)

        for batch in batches:
            if not batch.num_rows:
                continue
            band, no = batch.column("band").to_numpy(), batch.column("no").to_numpy()
            if open_band is not None:
                k = int(np.searchsorted(band, open_band, "right"))
                if k:
                    yield as_members(open_band, no[:k], passed)
                    passed += k
                if k == len(band):
                    continue
                band, no, open_band = band[k:], no[k:], None
            if rest:
                band = np.concatenate([rest[0][0], band])
                no = np.concatenate([rest[0][1], no])
                rest = []
            last = int(np.searchsorted(band, band[-1], "left"))
            if last:
                yield from close(band[:last], no[:last])
            if len(band) - last > block:
                open_band, passed = int(band[-1]), len(band) - last
                yield as_members(open_band, no[last:], 0)
            else:
                rest = [(band[last:], no[last:])]
        if rest:
            yield from close(*rest[0])

    return run


def _estimated(threshold: float, deviations: float, m: int) -> Callable:
    """Pairs whose estimated similarity isn't clearly below the threshold."""
    slack = deviations * math.sqrt(threshold * (1 - threshold) / m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(n, m) for c in ("ra", "rb"))
            larger, smaller = (a > b).sum(1), (a < b).sum(1)
            sa, sb = (batch.column(c).to_numpy().astype(np.float64) for c in ("sa", "sb"))
            guess = likeliest(larger, smaller, m - larger - smaller, sa, sb)
            # sizes alone bound the similarity from above
            keep = (guess >= threshold - slack) & (np.minimum(sa, sb) >= threshold * np.maximum(sa, sb))
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return run


def _grams_of(text_of: Callable[[str | None], str], n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([ngrams(text_of(raw.as_py()), n).tobytes() for raw in batch.column("raw")], pa.binary())], names=["id", "grams"])

    return run


def _verified(threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("ga").to_pylist(), batch.column("gb").to_pylist())):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(p) + len(q) - len(np.union1d(p, q))
                keep[k] = both >= threshold * (len(p) + len(q) - both) - 1e-9
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return run


def identity(text: str | None) -> str:
    return text or ""


class Similar:
    """Similar records of a table.

    records: (id string, raw string); rows without id or without an n-gram take part in no pair,
    repeated ids count once, ``text_of`` turns raw into text.  ``classes`` has one row for each id that
    has n-grams: (id, no, rep) with rep the record number of its class's representative; ``links`` has
    the similar pairs (a, b) of representatives, a < b, all at ``threshold`` or more.
    """

    def __init__(self, records: DataFrame, n: int, threshold: float, text_of: Callable[[str | None], str] = identity, rows: int = 6, miss: float = 0.0005, estimate: int = 64, deviations: float = 4.5) -> None:
        bands = rows_and_bands(threshold, miss, rows)
        m = max(rows * bands, estimate)
        if m > 1024:
            raise ValueError(f"{m} registers are more than the hash constants serve; use fewer rows or a larger miss")
        records = spread(records.select("id", "raw"))
        sketches = cut(records.mapInArrow(_sketched(text_of, n, m, rows, bands, estimate), SKETCHED), "sketches")
        # one record for each id, then one for each set; only these few columns cross the network for it
        one = sketches.groupBy("id").agg(F.min(F.struct("no", "class_key")).alias("r")).select("id", "r.no", "r.class_key")
        kept = cut(one, "kept")
        reps = kept.groupBy("class_key").agg(F.min("no").alias("rep"))
        self.classes = cut(kept.join(reps, "class_key").select("id", "no", "rep"), "classes")
        repeated = sketches.select("no").join(self.classes.filter("no = rep").select("no"), "no", "left_anti")
        pairs = proposed(sketches, repeated, bands)
        short = sketches.select("no", "size", F.col("registers").alias("r"))
        left = pairs.join(short.select(F.col("no").alias("a"), F.col("size").alias("sa"), F.col("r").alias("ra")), "a")
        both = left.join(short.select(F.col("no").alias("b"), F.col("size").alias("sb"), F.col("r").alias("rb")), "b")
        likely = cut(both.mapInArrow(_estimated(threshold, deviations, estimate), "a bigint, b bigint"), "likely")
        ends = likely.select(F.explode(F.array("a", "b")).alias("no")).distinct()
        named = cut(self.classes.join(ends, "no").select("id", "no"), "ends")
        # only records of likely pairs are read again; the join makes a filter exact
        grams = cut(narrowed(records, "id", named).mapInArrow(_grams_of(text_of, n), "id string, grams binary").join(named, "id").dropDuplicates(["id"]).select("no", "grams"), "grams")
        full = likely.join(grams.select(F.col("no").alias("a"), F.col("grams").alias("ga")), "a").join(grams.select(F.col("no").alias("b"), F.col("grams").alias("gb")), "b")
        self.links = cut(full.mapInArrow(_verified(threshold), "a bigint, b bigint"), "links")

    def pairs(self) -> DataFrame:
        """All similar pairs of ids (id_a, id_b), id_a < id_b, with the members of classes expanded."""
        within = self.classes.select("rep", F.col("id").alias("id_a")).join(self.classes.select("rep", F.col("id").alias("id_b")), "rep").filter("id_a < id_b").select("id_a", "id_b")
        a = self.classes.select(F.col("rep").alias("a"), F.col("id").alias("x"))
        b = self.classes.select(F.col("rep").alias("b"), F.col("id").alias("y"))
        across = self.links.join(a, "a").join(b, "b").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
        return within.unionByName(across)


def posting_text(raw: str | None) -> str:
    return body_of(raw)
