"""Incremental runs: micro-batches of a record stream merged into versioned state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.merge import last_of_key, upsert
from millrace.sources.sinks import VersionedTable


def merge_stream(stream: DataFrame, table: VersionedTable, keys: list[str], order: str, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merge every micro-batch into a table, and stop when the source has no more; of a ``PartedTable`` a batch rewrites the parts that it touches.

    Of a key's rows in one batch the last by ``order`` counts; a row older than the stored one by ``order`` changes
    nothing, so a batch that is run again after a failure leaves the same state.
    """

    def newer(old: DataFrame, new: DataFrame) -> DataFrame:
        known = old.select(*keys, F.col(order).alias("_o"))
        fresh = new.join(known, keys, "left").filter(F.col("_o").isNull() | (F.col(order) >= F.col("_o"))).drop("_o")
        return upsert(old, fresh, keys, {})

    def step(batch: DataFrame, number: int) -> None:
        table.update(last_of_key(batch, keys, [F.col(order)]), merge or newer)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parquet_stream(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """Parquet files as a stream, some files to a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed_counts(events: DataFrame, time: str, size: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Rows and distinct-free sums per window of event time; rows later than ``late`` behind the newest are left out on a stream."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    out = e.groupBy(F.window(time, size).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "n")


def sessions(events: DataFrame, time: str, gap: str, keys: list[str]) -> DataFrame:
    """Sessions of events that follow each other within a gap: start, end and number of events."""
    e = events.withWatermark(time, gap) if events.isStreaming else events
    out = e.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
