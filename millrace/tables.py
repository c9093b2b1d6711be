"""Reading the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.session import ready


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder that holds a Parquet file or directory ``<name>.parquet`` for each."""
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")
