"""Nearest neighbours by vector, with filters that give way pass by pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one block of the neighbours' side holds, about.
BLOCK = 4096


def _vectors(column: pa.Array) -> np.ndarray:
    x = np.array(column.to_pylist(), dtype=np.float32)
    if not len(x):
        return x.reshape(0, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _dealt(rows: DataFrame, name: str, size: int, within: str | None) -> DataFrame:
    """rows with the number of their block of about ``size`` rows; each value of ``within`` has blocks of its own, null has none."""
    if within is None:
        return rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(max(1, -(-rows.count() // size)))))
    sizes = rows.groupBy(within).agg(F.ceil(F.count("*") / size).alias("_blocks"))
    return rows.join(sizes, within).withColumn(name, F.pmod(F.xxhash64("id"), F.col("_blocks"))).drop("_blocks")


def nearest(queries: DataFrame, base: DataFrame, k: int, least: float = -1.0, room: int = 4096, within: str | None = None) -> DataFrame:
    """The k most similar base rows of each query by cosine: (query_id, id, score, rank); ties by id; a row isn't its own neighbour.

    queries, base: (id bigint, vector array<float>).  A stated query set against all rows, in blocks: every block of
    queries meets every block of base rows, keeps k a query, and the blocks' best are ranked at the end.
    within: a column of both; a query is then searched among the rows of its own value only, before the k are taken.
    """
    own = [within] if within else []
    blocks = _dealt(queries, "block", room, within).groupBy(*own, "block").agg(F.collect_list(F.struct(F.col("id").alias("query_id"), F.col("vector").alias("query"))).alias("queries"))
    spread = _dealt(base, "part", BLOCK, within).groupBy(*own, "part").agg(F.collect_list(F.struct("id", "vector")).alias("rows"))
    pairs = blocks.join(spread, own) if own else blocks.join(spread)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                qs, rows = batch.column("queries")[r].as_py(), batch.column("rows")[r].as_py()
                a = _vectors(pa.array([x["query"] for x in qs]))
                b = _vectors(pa.array([x["vector"] for x in rows]))
                qi, bi = np.array([x["query_id"] for x in qs]), np.array([x["id"] for x in rows])
                s = (a @ b.T).astype(np.float64)
                s[qi[:, None] == bi[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(bi, s.shape), -s), axis=1)[:, :k]
                score = np.take_along_axis(s, order, 1)
                ok = score >= max(least, -1.0)
                row = np.repeat(np.arange(len(qi)), ok.sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(qi[row]), pa.array(bi[order[ok]]), pa.array(score[ok])], names=["query_id", "id", "score"])

    found = pairs.repartition(*own, "block", "part").mapInArrow(best, "query_id bigint, id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def one_per_owner(hits: DataFrame, most: int, query: str = "query_id", owner: str = "owner") -> DataFrame:
    """Recommendations from hits (query, id, owner, pass_no, score): each id and owner once, earlier passes and higher scores first, at most ``most``.

    A hit without owner counts as its own.
    """
    h = hits.withColumn("_owner", F.coalesce(F.col(owner).cast("string"), F.concat(F.lit("#"), F.col("id").cast("string"))))
    order = [F.col("pass_no"), F.desc("score"), F.col("id")]
    h = h.withColumn("_a", F.row_number().over(Window.partitionBy(query, "id").orderBy(*order))).filter("_a = 1")
    h = h.withColumn("_b", F.row_number().over(Window.partitionBy(query, "_owner").orderBy(*order))).filter("_b = 1")
    return h.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(*order))).filter(F.col("rank") <= most).drop("_a", "_b", "_owner")
