import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import merge

T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
JOBS = "id string, content_hash string, title string, raw_json string, public_job_id string, first_seen_at timestamp, last_seen_at timestamp, removed_at timestamp, needs_parse boolean"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_rules(spark):
    t = spark.createDataFrame([("a", 1, "x", 5), ("b", 2, None, 9)], "k string, n int, s string, m int")
    s = spark.createDataFrame([("a", 7, None, 3), ("c", 3, "z", 1)], "k string, n int, s string, m int")
    assert rows(merge.upsert(t, s, ["k"], {"n": merge.keep_old, "m": merge.largest})) == [("a", 1, "x", 5), ("b", 2, None, 9), ("c", 3, "z", 1)]
    assert rows(merge.upsert(t, s.limit(0), ["k"], {})) == rows(t)
    assert rows(merge.upsert(t.limit(0), s, ["k"], {})) == rows(s)


def test_scraped_inserts_rewrites_and_revives(spark):
    t = spark.createDataFrame([("a", "h1", "A", "{}", "p", T1, T1, T1, False), ("b", "h2", "B", "{}", None, T1, T1, None, False), ("c", "h3", "C", "{}", None, T1, T1, None, False)], JOBS)
    s = spark.createDataFrame([("a", "h1", "A", "new", "q"), ("b", "h9", "B2", "new", "q"), ("d", "h4", "D", "new", "q")], "id string, content_hash string, title string, raw_json string, public_job_id string")
    out = {r["id"]: r for r in merge.scraped(t, s, F.lit("2025-02-01").cast("timestamp")).collect()}
    assert not out["a"]["needs_parse"] and out["a"]["removed_at"] is None and out["a"]["public_job_id"] == "p" and out["a"]["raw_json"] == "new"
    assert out["b"]["needs_parse"] and out["b"]["title"] == "B2" and out["b"]["public_job_id"] == "q"
    assert out["c"]["last_seen_at"] == T1 and out["d"]["first_seen_at"] == T2 and out["d"]["needs_parse"]


def test_absent_rows_of_delivered_scopes_only(spark):
    t = spark.createDataFrame([("a", "x", None), ("b", "x", T1), ("c", "x", None), ("d", "y", None)], "id string, board string, removed_at timestamp")
    seen = spark.createDataFrame([("a", "x")], "id string, board string")
    now = F.lit("2025-02-01").cast("timestamp")
    assert {r["id"]: r["removed_at"] for r in merge.mark_absent(t, seen, ["board"], now).collect()} == {"a": None, "b": T1, "c": T2, "d": None}
    none = merge.mark_absent(t, seen.limit(0), ["board"], now, scopes=spark.createDataFrame([("y",)], "board string"))
    assert {r["id"]: r["removed_at"] for r in none.collect()}["d"] == T2


def test_edges_parts_and_values(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "s string, t string")
    gone = spark.createDataFrame([("b",)], "id string")
    assert rows(merge.cascade(e, gone, ["s", "t"]).select("s", "t")) == [("c", "d")]
    assert rows(merge.replace_parts(e, spark.createDataFrame([("a", "z")], "s string, t string"), ["s"])) == [("a", "z"), ("b", "c"), ("c", "d")]
    t = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert rows(merge.differing_values(t, spark.createDataFrame([(1, "n"), (2, "x")], "k int, v string"), ["k"], "v")) == [(1, "n")]


def test_claims_number_on_and_skip_leased(spark):
    q = spark.createDataFrame([(f"j{i}", f"h{i}", i) for i in range(6)], "id string, content_hash string, n int")
    leases = spark.createDataFrame([("b", 4, "j5")], "batch_id string, request_index int, id string")
    assert rows(merge.claim(q, leases, "b", 2, [F.desc("n")])) == [("b", 5, "j4", "h4"), ("b", 6, "j3", "h3")]


def test_guarded_results(spark):
    t = spark.createDataFrame([("a", "1", None, None), ("b", "2", None, None), ("c", "3", None, T1)], "id string, v string, out string, removed_at timestamp")
    r = spark.createDataFrame([("a", "1", "x"), ("b", "9", "y"), ("c", "3", "z"), ("d", "1", "w")], "id string, v string, out string")
    state, late = merge.apply_guarded(t, r, "id", "v", ["out"], F.col("removed_at").isNull())
    assert {x["id"]: x["out"] for x in state.collect()} == {"a": "x", "b": None, "c": None}
    assert sorted(x["id"] for x in late.collect()) == ["b", "c", "d"]


def test_largest_remainder(spark):
    c = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20), ("d", 0)], "ats string, n int")
    assert rows(merge.allocated(c, 7)) == [("a", 4), ("b", 2), ("c", 1)]
    assert rows(merge.allocated(c, 1000)) == [("a", 50), ("b", 30), ("c", 20)]


def test_failures_stop_the_queue(spark):
    t = spark.createDataFrame([("a", 2, None, True), ("b", None, None, True)], "id string, parse_error_count int, last_parse_error string, needs_parse boolean")
    e = spark.createDataFrame([("a", "x" * 900), ("b", "y")], "id string, error string")
    out = {r["id"]: r for r in merge.failures(t, e).collect()}
    assert not out["a"]["needs_parse"] and len(out["a"]["last_parse_error"]) == 500 and out["b"]["needs_parse"] and out["b"]["parse_error_count"] == 1
