from pyspark.sql import functions as F

from millrace.operators import gazetteer as gz

C = ["RU\tx\tx\tx\tRuritania\tx\tx\t1000\tx\tx\tx\tx\tx\tx\tx\tx\t1\tx", "#c\tx", "US\tx\tx\tx\tUnited States\tx\tx\t5\tx\tx\tx\tx\tx\tx\tx\tx\t2\tx", "\tx"]
A = ["RU.SL\tStrelsau Province\tStrelsau Province\t3", "bad\tx\tx\t9", "XX.YY\tNowhere\tNowhere\t8"]
L = ["4\tHäntzau\tHantzau\tAlt,,Alt,Neu\t10.5\t20.5\tP\tPPL\tRU\t\tSL\t\t\t\t700\t\t\tEtc/UTC\t2020", "5\tLake\tLake\t\t1\t1\tH\tLK\tRU\t\tSL\t\t\t\t0\t\t\tEtc/UTC\t2020", "6\tFar\tFar\t\t\t\tP\tPPL\tQQ\t\tZZ\t\t\t\t\t\t\t\t"]


def fields(spark, lines):
    return spark.createDataFrame([(x.split("\t"),) for x in lines], "f array<string>")


def test_dumps_to_places_and_names(spark):
    c = gz.countries(fields(spark, C))
    r = gz.regions(fields(spark, A), c)
    p = gz.localities(fields(spark, L), c, r)
    assert {x["geoname_id"] for x in c.collect()} == {1, 2} and {x["geoname_id"]: x["country_name"] for x in r.collect()} == {3: "Ruritania", 8: None}
    rows = {x["geoname_id"]: x for x in p.collect()}
    assert set(rows) == {4, 6} and rows[4]["admin1_name"] == "Strelsau Province" and rows[4]["other_names"] == ["Alt", "Neu"] and rows[6]["latitude"] is None
    named = p.withColumn("display_name", gz.display_name(F.col("canonical_name"), F.col("admin1_name"), F.col("country_name")))
    names = gz.search_names(F.col("canonical_name"), F.col("ascii_name"), F.col("display_name"), F.col("country_code"), F.col("country_name"), F.col("admin1_code"), F.col("admin1_name"), F.col("other_names"))
    got = {x["geoname_id"]: x["search_names"] for x in gz.with_folded_names(named.withColumn("names", names)).collect()}
    assert {"hantzau", "alt", "hantzau ru", "hantzau strelsau", "hantzau strelsau province ruritania", "hantzau sl ru"} <= set(got[4]) and len(got[4]) == len(set(got[4]))


PLACES = "geoname_id bigint, kind string, canonical_name string, display_name string, country_code string, admin1_code string, admin1_name string, latitude double, longitude double, population bigint, search_names array<string>"


def places(spark):
    return spark.createDataFrame(
        [
            (1, "country", "Ruritania", "Ruritania", "RU", None, None, None, None, 9, ["ruritania"]), (3, "admin1", "Strelsau", "Strelsau, Ruritania", "RU", "SL", "Strelsau", 1.0, 2.0, 5, ["strelsau", "hentzau"]),
            (4, "locality", "Hentzau", "Hentzau, RU", "RU", "SL", "Strelsau", 3.0, 4.0, 2, ["hentzau", "hentzau ru"]), (5, "locality", "Hentzau", "Hentzau, ZU", "ZU", "NB", None, 5.0, 6.0, 7, ["hentzau", "hentzau zu"]),
        ], PLACES)


def test_candidates_in_order_and_ranks(spark):
    rows = spark.createDataFrame([(1, "Hentzau", None, None, None), (2, None, "hentzau", None, "zu"), (3, "nowhere", None, "Strelsau", "RU"), (4, None, None, None, "RU"), (5, "Remote", None, None, "RU"), (6, None, None, None, None)], "location_id bigint, label string, city string, state string, country_code string")
    rows = rows.withColumn("lat", F.lit(None).cast("double")).withColumn("lng", F.lit(None).cast("double")).withColumn("geoname_id", F.lit(None).cast("bigint"))
    out = {r["location_id"]: r for r in gz.resolved(rows, places(spark)).collect()}
    assert {k: r["geoname_id"] for k, r in out.items()} == {1: 3, 2: 5, 3: 3, 4: None, 5: None, 6: None}
    assert (out[2]["city"], out[2]["lat"], out[2]["label"]) == ("Hentzau", 5.0, "Hentzau, ZU") and out[3]["state"] == "Strelsau"


def test_typeahead_documents_and_dedupe(spark):
    assert [r["geoname_id"] for r in gz.typeahead(places(spark), " HENTZAU ", 5).collect()] == [5, 4, 3]
    assert [r["geoname_id"] for r in gz.typeahead(places(spark), "hentzau", 5, kind="locality", country="ru").collect()] == [4]
    docs = gz.place_documents(places(spark)).collect()
    assert [d["geoname_id"] for d in docs] == [1, 3, 5, 4] and docs[0]["point"] is None and docs[1]["region_key"] == "RU-SL"
    rows = spark.createDataFrame([(1, "a", 0, None), (1, "a", 1, 5.0), (1, "b", 2, None)], "job int, name string, pos int, lat double")
    best = gz.richer_first(rows, "job", ["name"], [F.col("lat").isNotNull().cast("int")], F.col("pos")).collect()
    assert sorted((r["name"], r["lat"], r["position"]) for r in best) == [("a", 5.0, 0), ("b", None, 2)]
