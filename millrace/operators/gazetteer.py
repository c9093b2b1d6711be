"""Gazetteers: building place rows from dumps, and resolving typed candidates by equi-joins on names."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import folded, nz
from millrace.text import fold

#: Further names of some countries.
COUNTRY_ALIASES = {"US": ["USA", "United States of America"], "GB": ["UK", "Great Britain", "Britain"], "AE": ["UAE"]}
#: Place kinds from the widest.
KINDS = ("country", "admin1", "locality")

KEPT = ["geoname_id", "kind", "canonical_name", "ascii_name", "display_name", "country_code", "country_name", "admin1_code", "admin1_name", "latitude", "longitude", "population", "timezone", "feature_class", "feature_code", "search_names"]


def kind_order(kind: Column, first: tuple[str, ...] = KINDS) -> Column:
    """0, 1, 2 by kind; others last."""
    out = F.lit(len(first))
    for n, k in enumerate(first):
        out = F.when(kind == k, F.lit(n)).otherwise(out)
    return out


def display_name(name: Column, admin1: Column, country: Column) -> Column:
    """name, region and country, without parts that repeat an earlier one once folded."""
    own, region = folded(name), folded(F.coalesce(admin1, F.lit("")))
    nation = folded(F.coalesce(country, F.lit("")))
    return F.concat_ws(", ", nz(name), F.when(region != own, nz(admin1)), F.when((nation != own) & (nation != region), nz(country)))


def search_names(name: Column, ascii_name: Column, shown: Column, country_code: Column, country: Column, admin1_code: Column, admin1: Column, extra: Column | None = None) -> Column:
    """All names of a place before folding (some may be null): its own, and each with every alias of its region and country."""
    aliases = F.create_map(*[x for k, v in COUNTRY_ALIASES.items() for x in (F.lit(k), F.array(*[F.lit(a) for a in v]))])
    none = F.array().cast("array<string>")
    countries = F.array_compact(F.concat(F.array(nz(country), nz(country_code)), F.coalesce(F.try_element_at(aliases, country_code), none)))
    short = nz(F.trim(F.regexp_replace(F.regexp_replace(admin1, r"(?i)\b(city|province|region|state|prefecture|district)\b", ""), r"\s+", " ")))
    regions = F.array_distinct(F.array_compact(F.array(nz(admin1), nz(admin1_code), short)))
    with_region = F.transform(regions, lambda r: F.concat_ws(" ", name, r))
    with_country = F.transform(countries, lambda c: F.concat_ws(" ", name, c))
    with_both = F.flatten(F.transform(regions, lambda r: F.transform(countries, lambda c: F.concat_ws(" ", name, r, c))))
    own = F.array(nz(name), nz(ascii_name), nz(shown))
    return F.array_distinct(F.concat(own, F.coalesce(extra, none) if extra is not None else none, with_country, with_region, with_both))


def with_folded_names(places: DataFrame, names: str = "names") -> DataFrame:
    """places with ``search_names``: the distinct folded names of an array column, in order, without blanks."""
    rest = [c for c in places.columns if c != names]
    schema = T.StructType([places.schema[c] for c in rest] + [T.StructField("search_names", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [None if x is None else list(dict.fromkeys(n for n in map(fold, x) if n)) for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(own, pa.list_(pa.string()))], names=[*rest, "search_names"])

    return places.select(*rest, names).mapInArrow(run, schema)


def countries(lines: DataFrame) -> DataFrame:
    """Country rows from a dump: a column ``f``, the fields of each line; comments and short lines left out."""
    f = lambda n: F.trim(F.get("f", n))
    own = lines.filter((F.size("f") >= 17) & ~F.get("f", 0).startswith("#") & (f(0) != "") & (f(4) != "") & f(16).try_cast("bigint").isNotNull())
    return own.select(f(16).try_cast("bigint").alias("geoname_id"), F.lit("country").alias("kind"), f(4).alias("canonical_name"), f(0).alias("country_code"), f(7).try_cast("bigint").alias("population"))


def regions(lines: DataFrame, country_rows: DataFrame) -> DataFrame:
    """First-level regions from a dump of (country.code, name, ascii name, id)."""
    f = lambda n: F.trim(F.get("f", n))
    own = lines.filter((F.size("f") >= 4) & F.contains(f(0), F.lit(".")) & f(3).try_cast("bigint").isNotNull())
    code = F.split(f(0), r"\.", 2)
    rows = own.select(f(3).try_cast("bigint").alias("geoname_id"), F.lit("admin1").alias("kind"), f(1).alias("canonical_name"), f(2).alias("ascii_name"), code[0].alias("country_code"), code[1].alias("admin1_code"))
    return rows.join(country_rows.select("country_code", F.col("canonical_name").alias("country_name")), "country_code", "left")


def localities(lines: DataFrame, country_rows: DataFrame, region_rows: DataFrame, most_names: int = 12) -> DataFrame:
    """Populated places from a dump of 19 fields, with the names of their region and country."""
    f = lambda n: F.trim(F.get("f", n))
    own = lines.filter((F.size("f") >= 19) & (f(6) == "P") & f(0).try_cast("bigint").isNotNull())
    rows = own.select(
        f(0).try_cast("bigint").alias("geoname_id"), F.lit("locality").alias("kind"), f(1).alias("canonical_name"), f(2).alias("ascii_name"), F.slice(F.array_distinct(F.filter(F.split(f(3), ","), lambda x: F.trim(x) != "")), 1, most_names).alias("other_names"),
        f(4).try_cast("double").alias("latitude"), f(5).try_cast("double").alias("longitude"), f(7).alias("feature_code"), f(8).alias("country_code"), f(10).alias("admin1_code"), f(14).try_cast("bigint").alias("population"), f(17).alias("timezone"),
    )
    named = rows.join(country_rows.select("country_code", F.col("canonical_name").alias("country_name")), "country_code", "left")
    return named.join(region_rows.select("country_code", "admin1_code", F.col("canonical_name").alias("admin1_name")), ["country_code", "admin1_code"], "left")


def postings(places: DataFrame) -> DataFrame:
    """The inverted list of a gazetteer: one row for each folded name of each place."""
    return places.select(F.explode(F.array_distinct("search_names")).alias("name"), "geoname_id", "kind", "country_code", "population", "display_name")


def looked_up(candidates: DataFrame, places: DataFrame) -> DataFrame:
    """The first candidate of each key that names a place, and the place.

    candidates: key, position, name (folded), kind (null: any), country_code (null: any).  Candidates are tried by
    position; of several places country goes before region before locality, then population, then display name.
    An equi-join on the name: distinct names only cross the network once per candidate.
    """
    c = candidates.filter(nz("name").isNotNull()).select("key", "position", "name", F.col("kind").alias("want_kind"), F.col("country_code").alias("want_country"))
    hits = c.join(postings(places), "name").filter((F.col("want_kind").isNull() | (F.col("kind") == F.col("want_kind"))) & (F.col("want_country").isNull() | (F.col("country_code") == F.col("want_country"))))
    best = F.struct("position", kind_order(F.col("kind")).alias("o"), (-F.coalesce("population", F.lit(-1))).alias("p"), "display_name", "geoname_id")
    return hits.groupBy("key").agg(F.min(best).alias("b")).select("key", F.col("b.position").alias("position"), F.col("b.geoname_id").alias("geoname_id"))


def location_candidates(rows: DataFrame, key: str = "location_id") -> DataFrame:
    """Candidates (key, position, name, kind, country_code) of typed locations, from the fullest form to the barest.

    rows: key, label, city, state, country_code.  A label that says remote without a city yields none.
    """
    code = F.when(F.length(F.trim("country_code")) == 2, F.upper(F.trim("country_code")))
    city, state, label = nz(F.trim("city")), nz(F.trim("state")), nz(F.trim("label"))
    join = lambda *c: F.when(sum((x.isNull().cast("int") for x in c), F.lit(0)) == 0, F.concat_ws(" ", *c))
    none = F.lit(None).cast("string")
    forms = [(label, none), (join(city, state, code), F.lit("locality")), (join(city, state), F.lit("locality")), (join(city, code), F.lit("locality")), (city, F.lit("locality")), (join(state, code), F.lit("admin1")), (state, F.lit("admin1")), (F.when(city.isNull(), code), F.lit("country"))]
    listed = F.array(*[F.struct(F.lit(n).alias("position"), name.alias("name"), kind.alias("kind")) for n, (name, kind) in enumerate(forms)])
    remote = F.coalesce(F.regexp(F.lower(label), F.lit(r"\b(remote|anywhere|worldwide|work from home)\b")), F.lit(False)) & city.isNull()
    out = rows.filter(~remote).select(F.col(key).alias("key"), F.explode(F.filter(listed, lambda x: x["name"].isNotNull())).alias("c"), code.alias("country_code"))
    return out.select("key", "c.position", folded(F.col("c.name")).alias("name"), "c.kind", F.when(F.col("c.kind") == "country", none).otherwise(F.col("country_code")).alias("country_code"))


def requirement_candidates(rows: DataFrame) -> DataFrame:
    """Candidates (key, position, name, kind, country_code) of applicant requirements by their scope.

    rows: key, scope (country, state, city; a group of regions and others yield none), name, region, country_code.
    """
    code = F.when(F.length(F.trim("country_code")) == 2, F.upper(F.trim("country_code")))
    name, region = nz(F.trim("name")), nz(F.trim("region"))
    all_of = lambda *c: F.when(sum((x.isNull().cast("int") for x in c), F.lit(0)) == 0, F.concat_ws(" ", *c))
    forms = {"country": [name, code], "state": [name, region], "city": [all_of(name, region, code), all_of(name, code), name]}
    kinds = {"country": "country", "state": "admin1", "city": "locality"}
    entries = F.array(*[F.struct(F.lit(n).alias("position"), F.when(F.col("scope") == scope, form).alias("name"), F.lit(kinds[scope]).alias("kind")) for scope, own in forms.items() for n, form in enumerate(own)])
    out = rows.select("key", F.explode(F.filter(entries, lambda x: x["name"].isNotNull())).alias("c"), code.alias("country_code"))
    return out.select("key", "c.position", folded(F.col("c.name")).alias("name"), "c.kind", F.when(F.col("c.kind") == "country", F.lit(None)).otherwise(F.col("country_code")).alias("country_code"))


def resolved(rows: DataFrame, places: DataFrame, key: str = "location_id") -> DataFrame:
    """Typed locations with the place that their fullest matching form names: id and what the place's kind fills in."""
    found = looked_up(location_candidates(rows, key), places)
    facts = places.select("geoname_id", "kind", F.col("display_name").alias("_label"), F.col("canonical_name").alias("_name"), F.col("admin1_name").alias("_state"), F.col("country_code").alias("_country"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lng"))
    j = rows.drop("geoname_id").join(found.withColumnRenamed("key", key), key, "left").join(facts, "geoname_id", "left")
    k = F.col("kind")
    city = F.when(k == "locality", F.col("_name")).otherwise(nz("city"))
    state = F.when(k == "locality", F.coalesce("_state", "state")).when(k == "admin1", F.col("_name")).when((k == "country") & nz("city").isNull(), F.lit(None)).otherwise(F.col("state"))
    return j.select(key, "geoname_id", F.coalesce("_label", "label").alias("label"), city.alias("city"), state.alias("state"), F.coalesce("_country", "country_code").alias("country_code"), F.when(k.isin("locality", "admin1"), F.coalesce("_lat", "lat")).otherwise(F.col("lat")).alias("lat"), F.when(k.isin("locality", "admin1"), F.coalesce("_lng", "lng")).otherwise(F.col("lng")).alias("lng"))


def typeahead(places: DataFrame, query: str, limit: int = 10, kind: str | None = None, country: str | None = None) -> DataFrame:
    """Places that a query names exactly once folded, localities first, then by population."""
    own = places.filter(F.array_contains("search_names", fold(query)))
    if kind:
        own = own.filter(F.col("kind") == kind)
    if country:
        own = own.filter(F.col("country_code") == country.upper())
    return own.orderBy(kind_order(F.col("kind"), ("locality", "admin1")), F.desc_nulls_last("population"), "display_name").limit(limit)


def place_documents(places: DataFrame) -> DataFrame:
    """Places as documents for a search index, in its order."""
    point = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng")))
    docs = places.select(F.col("geoname_id").cast("string").alias("id"), "geoname_id", "kind", kind_order(F.col("kind")).alias("kind_priority"), "display_name", "country_code", F.when((F.col("country_code") != "") & (F.col("admin1_code") != ""), F.concat_ws("-", "country_code", "admin1_code")).alias("region_key"), "population", (F.col("kind") == "locality").alias("supports_radius"), point.alias("point"))
    return docs.orderBy("kind_priority", F.desc_nulls_last("population"), "display_name")


def richer_first(rows: DataFrame, group: str, identity: list[str], quality: list[Column], order: Column) -> DataFrame:
    """Of entries of a group with one identity the richest, at the place of the first."""
    w = Window.partitionBy(group, *identity)
    best = F.row_number().over(w.orderBy(*[q.desc() for q in quality], order))
    return rows.withColumn("_first", F.min(order).over(w)).withColumn("_n", best).filter("_n = 1").drop("_n").withColumnRenamed("_first", "position")
