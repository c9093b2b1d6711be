"""Rewriting stored tables: upserts, soft deletes, leases and guarded updates as joins.

Plain Parquet has no row-level update, so each operator returns the table's new state (or what
changed) as one declarative plan: an outer join on the key and a rule for every column.  Each plan
shuffles both sides once, by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: From (old, new) to the column's next value.
Rule = Callable[[Column, Column], Column]

take_new: Rule = lambda old, new: new
keep_old: Rule = lambda old, new: F.coalesce(old, new)
prefer_new: Rule = lambda old, new: F.coalesce(new, old)
largest: Rule = lambda old, new: F.greatest(old, new)


def last_of_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the last by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc_nulls_last() for o in order])
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], rules: dict[str, Rule], default: Rule = prefer_new) -> DataFrame:
    """The target with the source's rows merged in; rules apply to rows that both have, others come as they are.

    Keys are unique on both sides and not null.  Columns that the source lacks keep their old value.
    """
    have = set(source.columns)
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns]).withColumn("_s", F.lit(True))
    t = target.withColumn("_t", F.lit(True))
    on = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    out = t.join(s, on, "full_outer")
    columns = []
    for c in target.columns:
        old, new = F.col(c), F.col(f"_s_{c}") if c in have else F.lit(None).cast(target.schema[c].dataType)
        both = rules.get(c, default)(old, new) if c in have else old
        columns.append(F.when(F.col("_s").isNull(), old).when(F.col("_t").isNull(), new).otherwise(both).cast(target.schema[c].dataType).alias(c))
    return out.select(*columns)


def classified(target: DataFrame, source: DataFrame, keys: list[str], version: str) -> DataFrame:
    """keys and change: new, changed, unchanged or absent, by comparing a version column null-safely."""
    t = target.select(*keys, F.col(version).alias("_old"), F.lit(True).alias("_t"))
    s = source.select(*keys, F.col(version).alias("_new"), F.lit(True).alias("_s"))
    j = t.join(s, keys, "full_outer")
    change = F.when(F.col("_t").isNull(), "new").when(F.col("_s").isNull(), "absent").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("changed")
    return j.select(*keys, change.alias("change"))


def scraped(target: DataFrame, source: DataFrame, now: Column, key: str = "id", version: str = "content_hash") -> DataFrame:
    """Stored postings after a fetch: new ones inserted, changed ones rewritten and queued, unchanged ones seen again; all live.

    target: key, version, title, raw_json, public_job_id, first_seen_at, last_seen_at, removed_at, needs_parse.
    """
    s = source.select(F.col(key), F.col(version).alias("_v"), F.col("title").alias("_title"), F.col("raw_json").alias("_raw"), F.col("public_job_id").alias("_public"), F.lit(True).alias("_s"))
    j = target.withColumn("_t", F.lit(True)).join(s, key, "full_outer")
    fresh, hit = F.col("_t").isNull(), F.col("_s").isNotNull()
    changed = hit & (fresh | ~F.col(version).eqNullSafe(F.col("_v")))
    value = {
        version: F.when(changed, F.col("_v")).otherwise(F.col(version)),
        "title": F.when(changed, F.col("_title")).otherwise(F.col("title")),
        "raw_json": F.when(hit, F.col("_raw")).otherwise(F.col("raw_json")),
        "public_job_id": F.coalesce("public_job_id", "_public"),
        "first_seen_at": F.when(fresh, now).otherwise(F.col("first_seen_at")),
        "last_seen_at": F.when(hit, now).otherwise(F.col("last_seen_at")),
        "removed_at": F.when(hit, F.lit(None)).otherwise(F.col("removed_at")),
        "needs_parse": F.when(changed, F.lit(True)).otherwise(F.col("needs_parse")),
    }
    return j.select(*[value[c].cast(target.schema[c].dataType).alias(c) if c in value else F.col(c) for c in target.columns])


def mark_absent(target: DataFrame, seen: DataFrame, scope: list[str], now: Column, key: str = "id", mark: str = "removed_at", scopes: DataFrame | None = None) -> DataFrame:
    """Rows of the given scopes whose key wasn't seen get a removal time, unless they have one.

    scopes: the scopes that were delivered whole (default: those of ``seen``); a scope in it without any seen
    key loses all its rows.
    """
    scopes = (scopes if scopes is not None else seen).select(*scope).distinct().withColumn("_scope", F.lit(True))
    hit = seen.select(key).distinct().withColumn("_seen", F.lit(True))
    j = target.join(scopes, scope, "left").join(hit, key, "left")
    gone = F.col("_scope").isNotNull() & F.col("_seen").isNull() & F.col(mark).isNull()
    return j.select(*[F.when(gone, now).otherwise(F.col(mark)).alias(mark) if c == mark else F.col(c) for c in target.columns])


def cascade(edges: DataFrame, gone: DataFrame, ends: list[str], key: str = "id") -> DataFrame:
    """Edges none of whose ends is gone."""
    for end in ends:
        edges = edges.join(gone.select(F.col(key).alias(end)).distinct(), end, "left_anti")
    return edges


def replace_parts(target: DataFrame, source: DataFrame, part: list[str]) -> DataFrame:
    """The target with whole parts replaced by the source's."""
    return target.join(source.select(*part).distinct(), part, "left_anti").unionByName(source)


def update_where(target: DataFrame, source: DataFrame, keys: list[str], values: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """Rows that the source names get new values; the rest, and unnamed columns, stay."""
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys]).withColumn("_s", F.lit(True))
    j = target.join(s, keys, "left")
    have = set(source.columns)
    return j.select(*[F.when(F.col("_s").isNotNull(), values[c](F.col(c), F.col(f"_s_{c}") if c in have else F.lit(None))).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns])


def differing_values(target: DataFrame, source: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys and new value where the source's value differs from the stored one; null counts as ''."""
    s = source.select(*keys, F.col(column).alias("_new"))
    return target.join(s, keys).filter(F.coalesce(column, F.lit("")) != F.col("_new")).select(*keys, F.col("_new").alias(column))


def failures(target: DataFrame, errors: DataFrame, key: str = "id", most: int = 3, message: int = 500) -> DataFrame:
    """Counts failures, keeps the message's beginning, and stops queueing after ``most``."""
    e = errors.select(key, F.left("error", F.lit(message)).alias("_e"))
    count = F.coalesce("parse_error_count", F.lit(0)) + 1
    j = target.join(e, key, "left")
    hit = F.col("_e").isNotNull()
    value = {"parse_error_count": F.when(hit, count).otherwise(F.col("parse_error_count")), "last_parse_error": F.when(hit, F.col("_e")).otherwise(F.col("last_parse_error")), "needs_parse": F.when(hit, count < most).otherwise(F.col("needs_parse"))}
    return j.select(*[value[c].alias(c) if c in value else F.col(c) for c in target.columns])


def claim(queue: DataFrame, leases: DataFrame, batch: str, limit: int, order: list[Column], key: str = "id", version: str = "content_hash") -> DataFrame:
    """The next ``limit`` free rows as leases (batch_id, request_index, key, version); numbered after the batch's own.

    One writer at a time takes leases; the version kept is what guards a later update.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    start = leases.filter(F.col("batch_id") == batch).agg(F.coalesce(F.max("request_index"), F.lit(-1)).alias("last"))
    free = queue.join(leases.select(key), key, "left_anti").orderBy(*order).limit(limit)
    number = F.row_number().over(Window.orderBy(*order))  # at most ``limit`` rows
    return free.withColumn("_n", number).crossJoin(F.broadcast(start)).select(F.lit(batch).alias("batch_id"), (F.col("last") + F.col("_n")).cast("int").alias("request_index"), key, version)


def apply_guarded(target: DataFrame, results: DataFrame, key: str, version: str, values: list[str], live: Column) -> tuple[DataFrame, DataFrame]:
    """Results applied where the row still has the version they were made for, and is live.

    Returns (the new state, results that came too late).
    """
    r = results.select(F.col(key), F.col(version).alias("_v"), *[F.col(c).alias(f"_s_{c}") for c in values])
    j = target.join(r, key, "left")
    fits = F.col("_v").isNotNull() & F.col(version).eqNullSafe(F.col("_v")) & live
    state = j.select(*[F.when(fits, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns])
    current = target.filter(live).select(F.col(key), F.col(version).alias("_now"))
    late = results.join(current, key, "left").filter(F.col("_now").isNull() | ~F.col("_now").eqNullSafe(F.col(version))).drop("_now")
    return state, late


def with_columns_of(df: DataFrame, schema) -> DataFrame:
    """df with exactly the schema's columns: missing ones null, others dropped, types cast (unreadable values null)."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def allocated(counts: DataFrame, total: int, group: str = "ats", n: str = "n") -> DataFrame:
    """(group, target): shares of ``total`` in proportion to n by largest remainder, ties by group, none above its n.

    counts has one row for each group; the window runs over those rows only.
    """
    every = Window.partitionBy(F.lit(0))
    whole = F.sum(n).over(every)
    exact = F.least(F.lit(total), whole).cast("double") * F.col(n) / whole
    shares = counts.filter(F.col(n) > 0).withColumn("_x", exact).withColumn("_f", F.floor("_x"))
    left = F.least(F.lit(total), whole) - F.sum("_f").over(every)
    rank = F.row_number().over(every.orderBy((F.col("_x") - F.col("_f")).desc(), F.col(group)))
    return shares.withColumn("_l", left).withColumn("_r", rank).select(group, F.least(F.col(n), F.col("_f") + F.when(F.col("_r") <= F.col("_l"), 1).otherwise(0)).alias("target"))
