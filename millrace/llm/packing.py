"""Filling containers of fixed capacity with texts.

Method: best-fit decreasing with a segment tree over remaining capacities.  Items of equal size are
interchangeable, so the rule runs on the counts of each size, which number at most the capacity, and
containers with equal remaining room are kept as ranges; the plan it yields is the one that placing
every item by itself would give.  Items are then ranked among those of their size, in parallel, and
look their containers up in the plan.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Items of one size that one task ranks, about: a size of more is split into as many ways as it takes.
WAY = 50_000


class Room:
    """Which remaining capacities some open container has: a segment tree of or-ed flags, of which only the set ones are kept."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.some: set[int] = set()

    def mark(self, room: int, some: bool) -> None:
        k = self.size + room
        if some:
            while k and k not in self.some:
                self.some.add(k)
                k >>= 1
        else:
            self.some.discard(k)
            k >>= 1
            while k and 2 * k not in self.some and 2 * k + 1 not in self.some:
                self.some.discard(k)
                k >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest marked capacity of at least ``least``, in logarithmic time."""
        k = self.size + least
        if k in self.some:
            return least
        while k > 1:
            if not k & 1 and k + 1 in self.some:
                k += 1
                while k < self.size:
                    k = 2 * k if 2 * k in self.some else 2 * k + 1
                return k - self.size
            k >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing of ``counts[size]`` items of each size into containers of ``capacity``.

    Returns the plan and the number of containers.  Rows of the plan: (size, first rank, items to a
    container, first container); items of the size, from that rank up to the next row's, go into
    consecutive containers, so many to each.
    """
    tree = Room(capacity)
    ranges: dict[int, deque[tuple[int, int]]] = {}
    plan: list[tuple[int, int, int, int]] = []
    opened = 0

    def add(room: int, first: int, many: int) -> None:
        if many and room:
            held = ranges.setdefault(room, deque())
            if not held:
                tree.mark(room, True)
            if held and held[-1][0] + held[-1][1] == first:
                held[-1] = (held[-1][0], held[-1][1] + many)
            else:
                held.append((first, many))

    for size in sorted((s for s in counts if s > 0), reverse=True):
        left, rank = counts[size], 0
        while left:
            room = tree.tightest(size)
            if room is None:
                each = capacity // size
                first, many = opened, -(-left // each)
                opened += many
                room = capacity
            else:
                # the tightest container takes items of this size until no more fit: it stays the tightest
                each = room // size
                first, many = ranges[room].popleft()
                use = min(many, -(-left // each))
                if use < many:
                    ranges[room].appendleft((first + use, many - use))
                if not ranges[room]:
                    tree.mark(room, False)
                many = use
            placed = min(left, many * each)
            plan.append((size, rank, each, first))
            whole, rest = divmod(placed, each)
            add(room - each * size, first, whole)
            if rest:
                add(room - rest * size, first + whole, 1)
            rank += placed
            left -= placed
    return np.array(plan, np.int64).reshape(-1, 4), opened


def _placed(plan: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """The container of items by size and rank. Items are numbered through all sizes in order, and the plan's rows likewise."""
    base = np.cumsum(counts) - counts
    number = lambda size, rank: base[np.searchsorted(sizes, size)] + rank
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    key = number(plan[:, 0], plan[:, 1])

    def containers(size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.full(len(size), -1, np.int64)
        some = size > 0
        if some.any():
            at = np.searchsorted(key, number(size[some], rank[some]), "right") - 1
            out[some] = plan[at, 3] + (rank[some] - plan[at, 1]) // plan[at, 2]
        return out

    return containers


def packed(sizes: DataFrame, capacity: int) -> DataFrame:
    """Containers of the items (doc bigint, tokens bigint).

    Returns one row for each item or piece: doc, piece, first_token, tokens, container (from 0).  Only an
    item larger than the capacity is split: into pieces of the capacity and one of what remains.  An
    item of 0 (or null) tokens takes no room: one row with a null container.  Repeated items are items of
    their own; no item is left out.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    tokens = F.greatest(F.coalesce(F.col("tokens").cast("bigint"), F.lit(0)), F.lit(0).cast("bigint"))
    pieces = (
        sizes.select("doc", tokens.alias("whole"))
        .select("doc", "whole", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.ceil(F.col("whole") / capacity) - 1))).alias("piece"))
        .select("doc", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col("whole") - F.col("piece") * capacity).alias("tokens"))
    )
    rows = pieces.groupBy("tokens").agg(F.count("*").alias("n")).toArrow()  # one row for each size that occurs: no more than the capacity has values
    size, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("tokens", "n"))
    order = np.argsort(size)
    size, n = size[order], n[order]
    ways = -(-n // WAY)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own = ways[np.searchsorted(size, b.column("tokens").to_numpy())]
                way = np.mod(b.column("deal").to_numpy(), own)
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(way.astype(np.int32))], names=[*b.schema.names[:4], "way"])

    split = pieces.withColumn("deal", F.xxhash64("doc", "piece")).mapInArrow(dealt, "doc bigint, piece int, first_token bigint, tokens bigint, way int")
    large = size[ways > 1]
    width = int(ways.max()) if len(ways) else 1
    starts = np.zeros((len(large), width + 1), np.int64)  # only of sizes that are split
    if len(large):
        many = split.filter(F.col("tokens").isin(large.tolist()) if len(large) <= 1000 else F.lit(True)).groupBy("tokens", "way").agg(F.count("*").alias("n")).toArrow()  # one row for about WAY items
        t, w, c = (many.column(x).to_numpy().astype(np.int64) for x in ("tokens", "way", "n"))
        known = np.isin(t, large)
        starts[np.searchsorted(large, t[known]), w[known] + 1] = c[known]
        starts = np.cumsum(starts, 1)
    plan, _ = best_fit_plan(dict(zip(size.tolist(), n.tolist())), capacity)
    container_of = _placed(plan, size, n)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, way, rank = b.column("tokens").to_numpy(), b.column("way").to_numpy(), b.column("within").to_numpy() - 1
                if len(large):
                    at = np.minimum(np.searchsorted(large, own), len(large) - 1)
                    rank = rank + np.where(large[at] == own, starts[at, way], 0)
                container = container_of(own, rank)
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(container, pa.int64(), mask=container < 0)], names=["doc", "piece", "first_token", "tokens", "container"])

    within = F.row_number().over(Window.partitionBy("tokens", "way").orderBy("doc", "piece", "first_token"))
    return split.withColumn("within", within.cast("bigint")).mapInArrow(ranked, "doc bigint, piece int, first_token bigint, tokens bigint, container bigint")


def filling(rows: DataFrame, capacity: int) -> DataFrame:
    """One row about a packing: containers, tokens, the least number of containers that could hold them, and the share of room filled."""
    out = rows.agg(F.coalesce(F.max("container") + 1, F.lit(0)).alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return out.select("containers", "tokens", F.ceil(F.col("tokens") / capacity).alias("least_containers"), F.when(F.col("containers") > 0, F.col("tokens") / (F.col("containers") * capacity)).alias("filled"))
