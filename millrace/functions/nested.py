"""Functions on JSON texts and nested values."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def merged_json(old: pd.Series, new: pd.Series) -> pd.Series:
    """The fields of two JSON objects, the second's where both have one; a side that is no object gives way to the other."""

    def load(x: str | None) -> dict | None:
        try:
            v = json.loads(x) if x else None
        except ValueError:
            return None
        return v if isinstance(v, dict) else None

    def one(a: str | None, b: str | None) -> str | None:
        p, q = load(a), load(b)
        return None if p is None and q is None else json.dumps({**(p or {}), **(q or {})}, ensure_ascii=False)

    return pd.Series([one(a, b) for a, b in zip(old, new)])


@F.pandas_udf(T.StringType())
def canonical_json(s: pd.Series) -> pd.Series:
    """JSON with sorted keys and no spare spaces; null if it can't be read."""

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(json.loads(x), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return None

    return s.map(one)


def differing_fields(a: Column, b: Column) -> Column:
    """array<struct<field, before, after>> of the top-level fields in which two JSON objects differ, sorted by field."""
    p, q = (F.coalesce(F.from_json(x, "map<string,string>"), F.create_map().cast("map<string,string>")) for x in (a, b))
    keys = F.array_sort(F.array_distinct(F.concat(F.map_keys(p), F.map_keys(q))))
    rows = F.transform(keys, lambda k: F.struct(k.alias("field"), F.try_element_at(p, k).alias("before"), F.try_element_at(q, k).alias("after")))
    return F.filter(rows, lambda r: ~r["before"].eqNullSafe(r["after"]))


def unfenced(c: Column) -> Column:
    """A model's answer without a code fence around it."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit("")), c)


def answer(c: Column, flat: str, nested: str, convert) -> Column:
    """A model's answer as a struct: read in the flat schema and converted, else in the nested one; null if neither fits."""
    text = F.trim(unfenced(c))
    f = F.from_json(text, flat)
    return F.coalesce(F.when(f.isNotNull(), convert(f)), F.from_json(text, nested))


def sampled(rows: DataFrame, group: list[str], n: int, key: str, seed: int = 1) -> DataFrame:
    """n rows of each group by a fixed shuffle of the key: the same rows whenever it runs (a sampling operator)."""
    w = Window.partitionBy(*group).orderBy(F.xxhash64(key, F.lit(seed)), key)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def canonical_tags(primary: Column, tags: Column, order: list[str]) -> Column:
    """The primary tag and then the other known ones, once each, in the list's order."""
    known = F.array(*[F.lit(x) for x in order])
    first = F.when(F.array_contains(known, primary), F.array(primary)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(first, F.array_intersect(known, F.coalesce(tags, F.array().cast("array<string>")))))


def first_by_key(entries: Column, key) -> Column:
    """Of an array of structs the first with each key, in order."""
    start = F.slice(entries, 1, 0)
    keep = lambda seen, x: F.when(F.exists(seen, lambda y: key(y).eqNullSafe(key(x))), seen).otherwise(F.concat(seen, F.array(x)))
    return F.aggregate(entries, start, keep)
