import random

from pyspark.sql import functions as F

from millrace.operators import duplicates, recommend
from millrace.operators.components import components
from millrace.operators.slugs import slug_map


def test_components_match_brute_force(spark):
    r = random.Random(4)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    want = {x: find(x) for x in root}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_duplicates_by_hash_text_and_likeness(spark):
    base = "we look for a careful person who likes boats and does not mind rain, and who can tell a knot from a loop at night"
    rows = [("a", "x", "h1", "one text"), ("b", "x", "h1", None), ("c", "x", "", base), ("d", "x", None, base.replace("boats", "boots", 1)), ("e", "y", "h1", base), ("f", "x", "h7", "something else entirely"), ("g", "x", "h8", base)]
    df = spark.createDataFrame(rows, "id string, title string, hash string, text string")
    got = {r["id"]: r["group_id"] for r in duplicates.duplicate_groups(df, ["title"]).collect()}
    assert set(got) == {"a", "b", "c", "d", "g"} and got["a"] == got["b"] != got["c"] == got["d"] == got["g"]


def test_changed_groups_and_lines(spark):
    f = lambda rows: spark.createDataFrame(rows, "id string, group_id string")
    assert sorted(r["id"] for r in duplicates.changed_groups(f([("a", "1"), ("b", "1"), ("c", "2")]), f([("a", "1"), ("b", "3"), ("c", "2")])).collect()) == ["a", "b"]
    d = spark.createDataFrame([(i, "s", ["x", "x", f"own{i}"]) for i in range(3)] + [(9, "t", ["x"])], "id int, source string, h array<string>")
    assert [tuple(r) for r in duplicates.repeated_line_hashes(d, ["source"], F.col("h")).collect()] == [("s", "x", 3, 3)]


def test_nearest_and_one_per_owner(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(60)] + [(100, [0.0] * 8)]
    df = spark.createDataFrame(rows, "id bigint, vector array<float>")
    got = {(x["query_id"], x["rank"]): x["id"] for x in recommend.nearest(df.filter("id < 5"), df, 3, room=2).collect()}
    norm = lambda v: sum(x * x for x in v) ** 0.5 or 1
    for q in range(5):
        s = sorted(((-sum(a * b for a, b in zip(rows[q][1], v)) / norm(rows[q][1]) / norm(v), i) for i, v in rows if i != q))[:3]
        assert [got[q, k] for k in (1, 2, 3)] == [i for _, i in s]
    hits = spark.createDataFrame([(1, 10, "a", 1, 0.9), (1, 11, "a", 0, 0.5), (1, 12, None, 1, 0.8), (1, 13, None, 1, 0.7), (1, 10, "a", 0, 0.4)], "query_id bigint, id bigint, owner string, pass_no int, score double")
    assert [(x["id"], x["rank"]) for x in sorted(recommend.one_per_owner(hits, 2).collect(), key=lambda x: x["rank"])] == [(11, 1), (12, 2)]


def test_slugs_are_unique_per_company(spark):
    rows = [("l", "t1", "Acme", "acme.example"), ("g", "t2", "Acme", "https://www.acme.example/"), ("g", "t3", "ACME!", "other.example"), ("g", "t4", "Acme", None), ("g", "t5", None, None), ("a", "t5", None, None), ("g", "t6", "acme other", None)]
    got = {(r["ats"], r["board_token"]): r["slug"] for r in slug_map(spark.createDataFrame(rows, "ats string, board_token string, company_name string, domain string")).collect()}
    assert got["l", "t1"] == got["g", "t2"] == "acme" and got["g", "t6"] == "acme-other" and len(set(got.values())) == 6
    assert got["g", "t3"].startswith("acme-") and got["g", "t3"] != "acme-other"
