import datetime as dt
import json
import sys
import types

from pyspark.sql import functions as F

from millrace import scratch
from millrace.sources import postings, readers, sinks
from millrace.streaming import changes


def test_lists(spark, tmp_path):
    (tmp_path / "c.txt").write_text("# boards\n\nlever:acme\n  plain \nashby: a:b \nlever:acme\n")
    assert [tuple(r)[1:] for r in readers.companies(spark, str(tmp_path / "c.txt")).orderBy("line_no").collect()] == [("lever", "acme"), ("greenhouse", "plain"), ("ashby", "a:b"), ("lever", "acme")]
    (tmp_path / "t.txt").write_text("b\n#x\na\nb\n")
    assert [r["token"] for r in readers.tokens(spark, str(tmp_path / "t.txt")).orderBy("line_no").collect()] == ["b", "a"]
    (tmp_path / "d.tsv").write_text("#c\na\tb\t\n")
    assert readers.fields(spark, str(tmp_path / "d.tsv")).first()["f"] == ["a", "b", ""]


def test_rate_feed(spark):
    xml = "<e:Envelope xmlns:e='u'><Cube><Cube time='2025-03-07'><Cube currency='USD' rate='1.1'/><Cube currency='gbp' rate='0.5'/><Cube currency='BAD' rate='x'/></Cube></Cube></e:Envelope>"
    df = spark.createDataFrame([(xml,), ("<a/>",)], "xml string")
    got = {r["currency_code"]: (r["as_of_date"], round(r["usd_per_unit"], 6)) for r in readers.usd_rates(df).collect()}
    assert got == {"USD": (dt.date(2025, 3, 7), 1.0), "GBP": (dt.date(2025, 3, 7), 2.2), "EUR": (dt.date(2025, 3, 7), 1.1)}


def test_batch_results_by_id(spark):
    lines = [{"metadata": {"job_id": "a"}, "response": {"x": 1}}, {"metadata": {"job_id": "b"}, "error": {"message": "no"}}, {"output": {"metadata": {"job_id": "c"}, "candidates": [1]}}, {"metadata": {"job_id": "z"}, "candidates": []}]
    df = spark.createDataFrame([(json.dumps(x),) for x in lines] + [(" ",)], "value string")
    leases = spark.createDataFrame([("c",), ("b",), ("a",), ("d",)], "job_id string")
    got = {r["job_id"]: r["status"] for r in readers.matched_results(readers.batch_results(df), leases).collect()}
    assert got == {"a": "matched", "b": "failed", "c": "matched", "d": "missing", "z": "unknown"}


def test_probe_classes(spark):
    rows = [
        (200, None, '{"jobs": []}', "ok"), (200, None, '{"jobs": null}', "ok"), (200, "challenge", '{"jobs": [{"title": "captcha attention required"}]}', "ok"), (200, None, "[1]", "unexpected_json_200"), (200, None, '{"name": "x"}', "unexpected_json_200"),
        (200, None, "<html><title>Security challenge</title>", "non_json_200"), (200, None, None, "non_json_200"), (403, "challenge", "", "challenge"), (403, None, "<title>Security\n challenge </title>", "challenge"), (403, None, "Just a moment...", "error"), (500, None, "", "error"), (None, None, None, "request_error"),
    ]
    df = spark.createDataFrame(rows, "status int, mitigated string, body string, want string")
    for r in df.select("*", readers.probe_class(F.col("status"), F.col("mitigated"), F.col("body")).alias("got")).collect():
        assert r["got"] == r["want"], r


def test_payloads_in_common_form(spark):
    rows = [
        ("greenhouse", "g", {"id": 5, "title": "T", "content": "&lt;p&gt;", "location": {"name": "X"}, "absolute_url": "u", "first_published": "2025-01-02T00:00:00Z", "departments": [{"name": "D"}], "offices": [{"name": "O"}]}),
        ("lever", "l", {"id": "i", "text": "T", "descriptionPlain": "P", "lists": [{"text": "a", "content": "b"}], "additionalPlain": "E", "categories": {"location": "X", "commitment": "Full"}, "hostedUrl": "h", "createdAt": 1735787045000}),
        ("workable", "w", {"shortcode": "S", "title": "T", "description": "d", "locations": [{"city": "C", "region": "", "country": "L"}, {"city": "H", "hidden": True}], "telecommuting": True, "url": "u"}),
        ("unknown", "u", {"id": 1}),
    ]
    df = spark.createDataFrame([(a, b, json.dumps(c)) for a, b, c in rows], "ats string, board_token string, raw string")
    got = {r["id"]: r for r in postings.normalized(df).collect()}
    assert set(got) == {"greenhouse__g__5", "lever__l__i", "workable__w__S"}
    assert got["lever__l__i"]["description"] == "P\n\na\nb\n\nE" and got["workable__w__S"]["locations"] == ["C, L"] and got["workable__w__S"]["workplace_type"] == "remote"
    assert got["greenhouse__g__5"]["department"] == "D" and got["greenhouse__g__5"]["location"] == "X"


def test_entries_of_one_key_and_stored_details(spark):
    rows = spark.createDataFrame([("S", 1, None, ["a"]), ("S", 0, "", ["b", "a"]), ("S", 2, "d", [])], "shortcode string, position int, department string, locations array<string>")
    assert tuple(postings.one_per_shortcode(rows).first()) == ("S", "d", ["b", "a"])
    listed = spark.createDataFrame([("a", None), ("b", None), ("c", None)], "id string, description string")
    stored = spark.createDataFrame([("a", "x", "y", "z", False), ("b", "x", "", "z", None), ("c", "x", "y", "z", True)], "id string, description string, descriptionHtml string, datePosted string, inactive boolean")
    done, fetch = postings.with_stored_details(listed, stored)
    assert [(r["id"], r["description"]) for r in done.collect()] == [("a", "x")] and [r["id"] for r in fetch.collect()] == ["b"]


def test_boards_source(spark):
    module = types.ModuleType("fetcher_for_tests")
    module.fetch = lambda ats, token: [{"id": f"{ats}-{token}"}]
    sys.modules["fetcher_for_tests"] = module
    reader = postings.BoardReader({"boards": "lever:a, ashby:b", "fetcher": "fetcher_for_tests:fetch"})
    assert [row for p in reader.partitions() for row in reader.read(p)] == [("lever", "a", '{"id": "lever-a"}'), ("ashby", "b", '{"id": "ashby-b"}')]


def test_versioned_table(spark, tmp_path):
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    t.write(spark.range(3))
    old = t.read()
    t.write(spark.range(5))
    assert old.count() == 3 and t.read().count() == 5
    t.vacuum()
    assert t.read().count() == 5 and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == 1


def test_delivery_in_chunks_with_retries(spark, tmp_path):
    folder = str(tmp_path)

    def send(rows):
        import os
        import uuid

        if not os.path.exists(f"{folder}/failed"):
            open(f"{folder}/failed", "w").close()
            raise OSError("once")
        with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump([r["id"] for r in rows], f)

    sinks.deliver(spark.range(25).repartition(2), send, chunk=10, pause=0.01)
    parts = [json.loads(p.read_text()) for p in tmp_path.glob("*.json")]
    assert sorted(x for p in parts for x in p) == list(range(25)) and max(map(len, parts)) <= 10


def test_json_lines_and_index_changes(spark, tmp_path):
    path = str(tmp_path / "o")
    sinks.write_json_lines(spark.createDataFrame([(1, "é")], "id int, s string"), path)
    assert [tuple(r) for r in readers.json_lines(spark, path, "id int, s string").collect()] == [(1, "é")]
    now = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "id string, version string")
    docs = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], "id string, version string")
    send, gone = sinks.index_changes(now, docs)
    assert sorted(r["id"] for r in send.collect()) == ["b", "d"] and [r["id"] for r in gone.collect()] == ["c"]


def test_stream_ends_where_a_batch_would(spark, tmp_path):
    rows = [(f"k{i % 7}", i, i * 10) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, at int, v int")
    df.repartition(6).write.parquet(str(tmp_path / "in"))
    held = sinks.VersionedTable(spark, str(tmp_path / "state"))
    changes.merge_stream(changes.parquet_stream(spark, str(tmp_path / "in"), df.schema), held, ["k"], "at", str(tmp_path / "p")).awaitTermination()
    want = {}
    for k, at, v in rows:
        want[k] = (at, v)
    assert {r["k"]: (r["at"], r["v"]) for r in held.read().collect()} == want


def test_scratch_needs_a_shared_folder(spark):
    df = scratch.cut(spark.range(4), "t")
    assert df.count() == 4 and scratch.folder(spark) == scratch.folder(spark)


def test_entry_without_the_text_package():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {"p2_found", "p4_found", "p6_found"} <= set(names) and set(entry.oracle_sql()) <= set(names)


def test_parted_table_rewrites_what_it_touches(spark, tmp_path):
    t = sinks.PartedTable(spark, str(tmp_path / "t"), ["k"], parts=8)
    assert t.read() is None
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    newer = lambda old, new: old.join(new, "k", "left_anti").unionByName(new)
    t.update(frame([(i, "a") for i in range(100)]), newer)
    before = t._named()
    t.update(frame([(3, "b"), (200, "c")]), newer)
    t.update(frame([]), newer)
    assert {(r["k"], r["v"]) for r in t.read().select("k", "v").collect()} == {(i, "b" if i == 3 else "a") for i in range(100)} | {(200, "c")}
    same = [p for p, v in t._named().items() if before.get(p) == v]
    assert len(same) >= 6 and len(list((tmp_path / "t").glob("v-*/part=*"))) == len(t._named())
    t.update(frame([(i, "x") for i in range(300)]), lambda old, new: new.limit(0))
    assert t.read() is None


def test_scope_deletes_what_was_written(spark):
    from pathlib import Path

    from millrace import scratch

    kept = scratch.cut(spark.range(3))
    with scratch.scope(spark):
        assert scratch.cut(spark.range(5)).count() == 5
        root = Path(scratch.folder(spark))
        assert root.exists()
    assert not root.exists() and kept.count() == 3
