"""Mixing sources to target weights.

Method: a low-discrepancy schedule.  The selection is a sequence of slots of equal size in tokens;
slot i maps the i-th golden-ratio point through the cumulative shares to a source, so every
stretch of the schedule holds the shares as nearly as whole slots can.  Slots are ranked among those
of their source, and the k-th takes the k-th block of tokens of the source's texts, which are
shuffled anew for each repetition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.scratch import cut

#: Tokens of a slot (a 4096th of the selection within these bounds); slots that one task numbers; buckets of a source's shuffled order; sources a mix may have.
LEAST_BLOCK, MOST_BLOCK, CHUNK, BUCKETS, MOST_SOURCES = 64, 1024, 1 << 16, 1024, 10_000
_GOLDEN = 0x9E3779B97F4A7C15  # 2**64 divided by the golden ratio, odd


def quotas(weights: np.ndarray, caps: np.ndarray, total: float) -> np.ndarray:
    """Tokens of each source: shares of ``total`` by weight, none above its cap; what capped sources can't give goes to the others by weight."""
    out = np.zeros(len(weights))
    open_ = (weights > 0) & (caps > 0)
    left = min(total, caps[open_].sum())
    while open_.any() and left > 0:
        share = np.where(open_, weights, 0) / weights[open_].sum() * left
        over = open_ & (share >= caps)
        if not over.any():
            out[open_] = share[open_]
            break
        out[over] = caps[over]
        left -= caps[over].sum()
        open_ &= ~over
    return out


def _points(first: int, n: int) -> np.ndarray:
    """Golden-ratio points first..first+n-1 as 64-bit fractions."""
    with np.errstate(over="ignore"):
        return (np.arange(first, first + n, dtype=np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN)


def _schedule(edges: np.ndarray, slots: int, counts_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = batch.column("chunk")[row].as_py()
                first = chunk * CHUNK
                n = min(CHUNK, slots - first)
                which = np.searchsorted(edges, _points(first, n), "right")
                if counts_only:
                    k, many = np.unique(which, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), chunk)), pa.array(k.astype(np.int32)), pa.array(many.astype(np.int64))], names=["chunk", "number", "n"])
                else:
                    before = dict(zip(batch.column("numbers")[row].as_py(), batch.column("before")[row].as_py()))
                    order = np.argsort(which, kind="stable")
                    start = np.searchsorted(which[order], np.arange(which.max() + 1))
                    rank = np.empty(n, np.int64)
                    rank[order] = np.arange(n) - start[which[order]]
                    rank += np.array([before.get(i, 0) for i in range(int(which.max()) + 1)], np.int64)[which]
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + n)), pa.array(which.astype(np.int32)), pa.array(rank)], names=["slot", "number", "block"])

    return run


class Mix:
    """A selection of texts (doc, source, tokens) by targets (source, weight, max_repeats).

    total: tokens to select; by default the size of the target sources' texts.  A source without target,
    or a target without texts, takes no part; so do texts of 0 tokens.  Null or non-positive weights and
    repeats count as 0; of repeated targets of a source the largest counts.  ``chosen`` has rows (slot, source, doc, repeat, tokens), repeat
    from 0; ``shares`` says for every target what share it was to have, could have and has.
    """

    def __init__(self, sizes: DataFrame, targets: DataFrame, total: int | None = None, block: int | None = None, seed: int = 17) -> None:
        spark = sizes.sparkSession
        sizes = sizes.select("doc", "source", F.col("tokens").cast("bigint").alias("tokens")).filter("tokens > 0 and source is not null")
        goals = targets.filter("source is not null").groupBy("source").agg(F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats")).orderBy("source").limit(MOST_SOURCES + 1).collect()
        if len(goals) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        named = [g["source"] for g in goals]
        have = {r["source"]: r["n"] for r in sizes.filter(F.col("source").isin(named)).groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
        clean = lambda v: float(v) if v is not None and v == v and v > 0 else 0.0
        weight = np.array([clean(g["weight"]) for g in goals])
        repeats = np.array([int(clean(g["max_repeats"])) for g in goals])
        tokens = np.array([have.get(s, 0) for s in named], np.float64)
        total = int(tokens.sum()) if total is None else total
        quota = quotas(weight, repeats * tokens, float(total))
        block = block or int(min(MOST_BLOCK, max(LEAST_BLOCK, quota.sum() // 4096)))
        slots = math.ceil(quota.sum() / block)
        whole = quota.sum() or 1.0
        edges = np.array([min(int(x * 2.0**64), (1 << 64) - 1) for x in np.cumsum(quota / whole)[:-1]], np.uint64) if len(quota) else np.zeros(0, np.uint64)
        chunks = spark.range(0, -(-slots // CHUNK), numPartitions=max(1, min(4096, -(-slots // CHUNK)))).select(F.col("id").alias("chunk"))
        counts = cut(chunks.mapInArrow(_schedule(edges, slots, True), "chunk bigint, number int, n bigint"), "slots")
        running = F.sum("n").over(Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
        before = counts.withColumn("before", F.coalesce(running, F.lit(0))).groupBy("chunk").agg(F.collect_list("number").alias("numbers"), F.collect_list("before").alias("before"))
        schedule = before.mapInArrow(_schedule(edges, slots, False), "slot bigint, number int, block bigint")
        given = {r["number"]: r["n"] for r in counts.groupBy("number").agg(F.sum("n").alias("n")).collect()}  # one row for each target
        facts = [(s, i, int(tokens[i]), min(int(repeats[i]), math.ceil((given.get(i, 0) + 1) * block / tokens[i])), given.get(i, 0)) for i, s in enumerate(named) if tokens[i] and quota[i] > 0]
        about = spark.createDataFrame(facts, "source string, number int, source_tokens bigint, epochs int, slots bigint")
        about = F.broadcast(about)  # at most MOST_SOURCES rows
        order = F.xxhash64("doc", "repeat", F.lit(seed))
        dealt = (
            sizes.join(about, "source")
            .withColumn("repeat", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
            .withColumn("order", order)
            .withColumn("bucket", F.shiftright(F.col("order"), 64 - int(math.log2(BUCKETS))))
        )
        key = ["number", "repeat", "bucket"]
        sums = dealt.groupBy(*key).agg(F.sum("tokens").alias("n"))
        so_far = F.sum("n").over(Window.partitionBy("number", "repeat").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        sums = sums.withColumn("skip", F.coalesce(so_far, F.lit(0))).drop("n")
        inside = F.sum("tokens").over(Window.partitionBy(*key).orderBy("order", "doc").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
        placed = dealt.withColumn("inside", inside).join(sums, key).withColumn("block", F.floor((F.col("repeat") * F.col("source_tokens") + F.col("skip") + F.col("inside")) / block))
        self.chosen = placed.filter("block < slots").join(schedule, ["number", "block"]).select("slot", "source", "doc", "repeat", "tokens")
        plan = [(s, float(weight[i]), int(repeats[i]), int(tokens[i]), float(weight[i] / weight.sum()) if weight.sum() else 0.0, float(quota[i] / whole)) for i, s in enumerate(named)]
        self._plan = spark.createDataFrame(plan, "source string, weight double, max_repeats int, source_tokens bigint, share_target double, share_possible double")

    def shares(self, chosen: DataFrame | None = None) -> DataFrame:
        """For each target: its share by weight, the share that max_repeats allows, and tokens, texts, repetitions and share reached."""
        got = (chosen if chosen is not None else self.chosen).groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("texts"), (F.max("repeat") + 1).alias("repeats"))
        out = self._plan.join(got, "source", "left")
        whole = F.sum("tokens").over(Window.partitionBy())  # over at most MOST_SOURCES rows
        return out.select("source", "weight", "max_repeats", "source_tokens", "share_target", "share_possible", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("repeats", F.lit(0)).alias("repeats"), F.coalesce(F.col("tokens") / whole, F.lit(0.0)).alias("share_reached"))
