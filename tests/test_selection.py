import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.operators import selection as sl


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_scopes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    one = spark.createDataFrame([("a",), ("a",)], "k string")
    assert ids(sl.in_scope(rows, one, ["k"])) == [1] and ids(sl.in_scope(rows, None, ["k"])) == [1, 2, 3] and ids(sl.in_scope(rows, one.limit(0), ["k"])) == []
    assert ids(sl.out_of_scope(rows, one, ["k"])) == [2, 3] and ids(sl.out_of_scope(rows, one.limit(0), ["k"])) == [1, 2, 3]


def test_by_ids_keeps_positions_and_reports_missing(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    found, missing = sl.by_ids(rows, spark.createDataFrame([(3, 0), (9, 1), (1, 2), (3, 3)], "id int, position int"))
    assert [r["id"] for r in found.orderBy("position").collect()] == [3, 1] and ids(missing) == [9]


def test_shards_cover_once(spark):
    rows = spark.createDataFrame([(f"t{i}", "x") for i in range(40)], "token string, ats string")
    want = {f"t{i}": int(hashlib.sha256(f"x:t{i}".encode()).hexdigest()[:16], 16) % 5 for i in range(40)}
    for n in range(5):
        assert {r["token"] for r in sl.in_shard(rows, ["ats", "token"], 5, n).collect()} == {t for t, s in want.items() if s == n}
    assert sl.in_shard(rows, ["ats", "token"], None, 1).count() == 40


def test_predicates(spark):
    rows = spark.createDataFrame([(1, True, 1, None), (2, False, 0, 5), (3, True, 0, 5)], "id int, needs_parse boolean, parse_error_count int, last_parsed_at int")
    assert [ids(rows.filter(sl.selected(n))) for n in sl.SELECTIONS] == [[1, 3], [1], [1]]
    with pytest.raises(ValueError):
        sl.selected("all")
    got = {r["id"]: r["pass_no"] for r in sl.passes(rows, [(0, F.col("id") == 2), (1, F.col("needs_parse"))]).collect()}
    assert got == {2: 0, 1: 1, 3: 1}
    places = spark.createDataFrame([(1, [(None,)], []), (2, [(5,)], [("region_group", None)]), (3, None, [("city", None)])], "id int, l array<struct<geoname_id:int>>, r array<struct<scope:string,geoname_id:int>>")
    assert ids(places.filter(sl.needs_places(F.col("l"), F.col("r")))) == [1, 3]
