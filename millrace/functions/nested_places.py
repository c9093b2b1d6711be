"""Labels and keys of a posting's nested locations and applicant requirements, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import nz, trimmed
from millrace.functions.values import country_code, region_key


def location_label(x: Column) -> Column:
    """A location's own label, else its city, state and country code with commas; null without any."""
    return F.coalesce(nz(x["label"]), nz(F.array_join(F.array_compact(F.array(nz(x["city"]), nz(x["state"]), nz(x["country_code"]))), ", ")))


def requirement_label(x: Column) -> Column:
    """A requirement's name, else the country code of a country's or the region of a state's or city's."""
    return F.coalesce(nz(x["name"]), F.when(x["scope"] == "country", nz(x["country_code"])), F.when(x["scope"].isin("state", "city"), nz(x["region"])))


def all_labels(locations: Column, requirements: Column, office: Column) -> Column:
    """Labels of the locations, once each; without any, those of the requirements of remote work."""
    own = F.array_distinct(F.array_compact(F.transform(locations, location_label)))
    wanted = F.array_distinct(F.array_compact(F.transform(requirements, requirement_label)))
    none = F.array().cast("array<string>")
    return F.when(F.size(own) > 0, own).when(office == "remote", F.coalesce(wanted, none)).otherwise(none)


def display_label(locations: Column, requirements: Column, office: Column) -> Column:
    """What a posting shows as its place: the first location, else up to two requirements of remote work and how many more."""
    labels = all_labels(locations, requirements, office)
    n = F.size(labels)
    shown = F.array_join(F.slice(labels, 1, 2), " • ")
    more = F.when(n > 2, F.concat(shown, F.lit(" +"), (n - 2).cast("string"), F.lit(" more"))).otherwise(shown)
    return F.when(F.coalesce(F.size(locations), F.lit(0)) > 0, F.coalesce(F.try_element_at(labels, F.lit(1)), F.lit(""))).when(office == "remote", more).otherwise("")


def geo_fields(locations: Column, requirements: Column) -> list[Column]:
    """The five key arrays of a posting's places, each value once, in order.

    Entries are structs with geoname_id, country_code, place_country and place_region (of their place, null if unknown), and scope for requirements.
    """
    kept = lambda a: F.array_distinct(F.filter(a, lambda v: v.isNotNull() & (v.cast("string") != "")))
    code = lambda x: country_code(F.coalesce(nz(x["place_country"]), x["country_code"]))
    region = lambda x: region_key(code(x), x["place_region"])
    stated = F.filter(requirements, lambda x: x["scope"].isin("country", "state", "city"))
    local = F.filter(requirements, lambda x: x["scope"].isin("state", "city"))
    return [
        kept(F.transform(locations, lambda x: x["geoname_id"])).alias("work_geoname_ids"), kept(F.transform(locations, code)).alias("work_country_codes"), kept(F.transform(locations, region)).alias("work_admin1_keys"),
        kept(F.transform(stated, code)).alias("applicant_country_codes"), kept(F.transform(local, region)).alias("applicant_admin1_keys"),
    ]


def context_lines(raw: Column) -> Column:
    """What a payload says beside title and body, as labelled lines, each once, in a fixed order."""
    get = lambda path: nz(F.trim(F.get_json_object(raw, f"$.{path}")))
    texts = lambda path: nz(F.array_join(F.from_json(F.get_json_object(raw, f"$.{path}"), "array<string>"), ", "))
    names = lambda path, kind, of: nz(F.array_join(F.filter(F.transform(F.from_json(F.get_json_object(raw, f"$.{path}"), f"array<struct<{kind}>>"), of), lambda v: v.isNotNull() & (v != "")), ", "))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    place = F.coalesce(get("location.name"), F.when(~F.get_json_object(raw, "$.location").startswith("{"), get("location")))
    everywhere = texts("allLocations")
    return F.array_distinct(
        F.array_compact(
            F.array(
                line("Location", place), line("Workplace type", get("workplaceType")), F.when(F.get_json_object(raw, "$.isRemote") == "true", "Remote flag: true"),
                line("Employment type", F.coalesce(get("employmentType"), get("commitment"))), line("Allowed locations", everywhere), line("Department", texts("departments")),
                line("Offices", names("offices", "location:string,name:string", lambda o: F.coalesce(nz(o["location"]), o["name"]))), line("Department", get("department")), line("Locations", everywhere),
                F.when(everywhere.isNull(), line("Location", get("categories.location"))), line("Location", get("locationName")),
                line("Location detail", F.concat(get("locationCity"), F.coalesce(F.concat(F.lit(", "), get("locationRegion")), F.lit("")), F.coalesce(F.concat(F.lit(", "), get("locationCountry")), F.lit("")))),
                line("Also in", names("secondaryLocations", "location:string", lambda o: o["location"])), line("Team", get("team")),
            )
        )
    )


def prompt_text(title: Column, raw: Column, body: Column, most: int = 32_000) -> Column:
    """Title, context lines and body, separated by blank lines, cut to ``most`` characters (the limit of who reads it)."""
    lines = F.array_join(context_lines(raw), "\n")
    return F.left(trimmed(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.when(lines != "", F.concat(lines, F.lit("\n\n"))).otherwise(""), F.coalesce(body, F.lit("")))), F.lit(most))
