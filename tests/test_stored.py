import pytest
from pyspark.sql import functions as F

from millrace.functions import nested_places as npl
from millrace.operators import companies, selection

LOCATION = "array<struct<label:string,city:string,state:string,country_code:string,geoname_id:bigint,place_country:string,place_region:string>>"
REQUIREMENT = "array<struct<scope:string,name:string,region:string,country_code:string,geoname_id:bigint,place_country:string,place_region:string>>"


def row(spark, locations, requirements, office):
    return spark.createDataFrame([(locations, requirements, office)], f"l {LOCATION}, r {REQUIREMENT}, o string")


def req(scope, name=None, region=None, code=None, country=None, admin=None):
    return (scope, name, region, code, None, country, admin)


@pytest.mark.parametrize(
    "locations, requirements, office, labels, display",
    [
        ([("L", "a", None, None, None, None, None), ("", "b", "", "DE", None, None, None), ("L", None, None, None, None, None, None)], [], "onsite", ["L", "b, DE"], "L"),
        ([], [req("country", None, None, "FR"), req("state", None, "Bay"), req("region_group", "EU"), req("city", "X", "Y"), req("region_group")], "remote", ["FR", "Bay", "EU", "X"], "FR • Bay +2 more"),
        (None, [req("country", "A"), req("country", "B"), req("country", "A")], "remote", ["A", "B"], "A • B"),
        ([], [req("country", "A")], "onsite", [], ""), (None, None, None, [], ""), ([("", None, "", None, None, None, None)], [req("country", "A")], "remote", ["A"], "A"),
    ],
)
def test_labels(spark, locations, requirements, office, labels, display):
    out = row(spark, locations, requirements, office).select(npl.all_labels(F.col("l"), F.col("r"), F.col("o")).alias("labels"), npl.display_label(F.col("l"), F.col("r"), F.col("o")).alias("display")).first()
    assert out["labels"] == labels and out["display"] == display


def test_geo_fields(spark):
    locations = [(None, None, None, "usa", 5, None, None), (None, None, None, "x", 5, "DE", "BY"), (None, None, None, None, None, None, None)]
    requirements = [req("country", code="United Kingdom"), req("state", country="DE", admin="BE"), req("city", code="fr"), req("region_group", code="IT")]
    out = row(spark, locations, requirements, None).select(*npl.geo_fields(F.col("l"), F.col("r"))).first()
    assert tuple(out) == ([5], ["US", "DE"], ["DE-BY"], ["GB", "DE", "FR"], ["DE-BE"])


def test_prompt_text(spark):
    raw = '{"location": {"name": " Rome "}, "isRemote": true, "departments": ["A", "B"], "offices": [{"name": "n"}, {"location": "l", "name": "m"}], "allLocations": ["X"], "department": "", "team": "T", "locationCity": "C", "locationCountry": "K", "secondaryLocations": [{"location": "S"}, {}]}'
    df = spark.createDataFrame([("Title", raw, "Body"), (None, "{}", None), ("T" * 50, None, "b")], "t string, raw string, body string")
    got = [r["v"] for r in df.select(npl.prompt_text(F.col("t"), F.col("raw"), F.col("body"), 400).alias("v")).collect()]
    assert got[0] == "Title\n\nLocation: Rome\nRemote flag: true\nAllowed locations: X\nDepartment: A, B\nOffices: n, l\nLocations: X\nLocation detail: C, K\nAlso in: S\nTeam: T\n\nBody"
    assert got[1] == "" and got[2] == "T" * 50 + "\n\nb"


def test_fetched_companies(spark):
    stored = spark.createDataFrame([("a", "x", "Name", "s", None, None, None, None, "ok", "err", 200, None, 5, True), ("a", "y", None, None, None, None, None, None, None, None, None, None, None, None)], "ats string, board_token string, company_name string, company_slug string, domain string, description string, logo_url string, scraped_logo_url string, scrape_status string, last_scrape_error string, last_http_status int, last_scraped_at timestamp, job_count int, active boolean")
    names = [*companies.FILLED, *companies.STATED]
    kind = ", ".join(f"{n} {'int' if n == 'last_http_status' else 'string'}" for n in names) + ", " + ", ".join(f"{n}_is_set boolean" for n in companies.STATED) + ", job_count int, job_count_exact boolean"
    fetched = spark.createDataFrame([("a", "x", None, "t", "d", None, None, None, "bad", None, 500, False, True, None, 2, False), ("b", "z", "New", None, None, None, None, None, "ok", None, 200, None, None, None, 0, False)], f"ats string, board_token string, {kind}")
    got = {(r["ats"], r["board_token"]): r for r in companies.upserted(stored, fetched, F.lit("2025-01-01").cast("timestamp")).collect()}
    x, z = got["a", "x"], got["b", "z"]
    assert (x["company_name"], x["company_slug"], x["domain"], x["scrape_status"], x["last_scrape_error"], x["last_http_status"], x["job_count"], x["active"]) == ("Name", "t", "d", "ok", None, 200, 5, True)
    assert (z["company_name"], z["scrape_status"], z["last_http_status"], z["job_count"], z["active"]) == ("New", "ok", 200, 0, False) and got["a", "y"]["last_scraped_at"] is None


def test_outdated(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", None), ("d", 2), ("e", None)], "id string, last_parsed_at int")
    made = spark.createDataFrame([("a", "v2", 1), ("b", "v1", 1), ("c", "v2", None), ("d", "v2", 1)], "id string, algorithm string, source int")
    assert {r["id"] for r in selection.outdated(rows, made, "v2").collect()} == {"b", "d", "e"}
