"""Choosing rows: scopes, id lists, shards, queue predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Predicates by which rows are chosen for a batch.
SELECTIONS = {"needs_parse": "needs_parse", "failed_once": "needs_parse and parse_error_count = 1", "never_parsed": "last_parsed_at is null"}


def selected(name: str) -> Column:
    """The predicate of a selection; unknown names are an error."""
    if name not in SELECTIONS:
        raise ValueError(f"unknown selection {name!r}; one of {', '.join(SELECTIONS)}")
    return F.expr(SELECTIONS[name])


def in_scope(rows: DataFrame, scope: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose keys are in the scope; None means all rows, an empty scope none."""
    return rows if scope is None else rows.join(scope.select(*keys).distinct(), keys, "left_semi")


def out_of_scope(rows: DataFrame, scope: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't in the scope; None or an empty scope leave all rows."""
    return rows if scope is None else rows.join(scope.select(*keys).distinct(), keys, "left_anti")


def by_ids(rows: DataFrame, wanted: DataFrame, key: str = "id", order: str = "position") -> tuple[DataFrame, DataFrame]:
    """(the wanted rows with their position, the wanted ids that don't exist)."""
    w = wanted.groupBy(key).agg(F.min(order).alias(order))
    return rows.join(w, key), w.join(rows.select(key), key, "left_anti").select(key)


def shard(parts: list[Column], shards: int) -> Column:
    """The shard of a key, 0..shards-1: the first 64 bits of its SHA-256, as an unsigned number, modulo."""
    key = F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 16)
    return (F.conv(key, 16, 10).cast("decimal(20,0)") % shards).cast("int")


def in_shard(rows: DataFrame, keys: list[str], shards: int | None, number: int | None) -> DataFrame:
    """Rows of one shard; all rows unless both numbers are given."""
    return rows if shards is None or number is None else rows.filter(shard([F.col(k) for k in keys], shards) == number)


def whole_delivery(fetched: Column, most: int | None) -> Column:
    """Whether a delivery can be taken for complete: fetched without a limit, or fewer rows than it."""
    return F.lit(True) if most is None else fetched < most


def needs_places(locations: Column, requirements: Column) -> Column:
    """Whether any location, or any requirement but a group of regions, lacks its place."""
    lacks = F.exists(locations, lambda x: x["geoname_id"].isNull())
    wants = F.exists(requirements, lambda x: (x["scope"] != "region_group") & x["geoname_id"].isNull())
    return F.coalesce(lacks, F.lit(False)) | F.coalesce(wants, F.lit(False))


def passes(rows: DataFrame, conditions: list[tuple[int, Column]]) -> DataFrame:
    """Rows with the number of the first condition they meet (pass_no); rows that meet none are left out."""
    number = F.lit(None).cast("int")
    for n, condition in reversed(conditions):
        number = F.when(condition, F.lit(n)).otherwise(number)
    return rows.withColumn("pass_no", number).filter("pass_no is not null")


def outdated(rows: DataFrame, made: DataFrame, algorithm: str, key: str = "id", version: str = "last_parsed_at") -> DataFrame:
    """Rows without a derived result (made: key, algorithm, source version), or with one of another algorithm or version."""
    m = made.select(key, F.col("algorithm").alias("_a"), F.col(made.columns[2]).alias("_v"), F.lit(True).alias("_m"))
    j = rows.join(m, key, "left")
    return j.filter(F.col("_m").isNull() | ~F.col("_a").eqNullSafe(algorithm) | ~F.col("_v").eqNullSafe(F.col(version))).select(*rows.columns)
