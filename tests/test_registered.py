"""Queries whose SQL says less than the operator of their name: the registered query gives what the SQL says."""

import numpy as np
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.plans import stored


def test_change_counts_gives_what_its_sql_says(spark, tmp_path):
    held = {1: {"a": "x", "b": "x", "c": None}, 2: {"a": "y", "c": None, "e": "x"}, 3: {"f": "x"}}
    rows = [(i, n, h, None, None, None) for n, own in held.items() for i, h in own.items()] + [(None, 2, "x", None, None, None), ("z", None, "x", None, None, None)]
    spark.createDataFrame(rows, "id string, snapshot_no int, content_hash string, delivered_at timestamp, last_seen_at timestamp, title string").write.parquet(f"{tmp_path}/job_snapshots.parquet")
    out = stored.QUERIES["change_counts"](spark, str(tmp_path))
    assert out.columns == ["change", "n"] and {tuple(x) for x in out.collect()} == {("changed", 1), ("absent", 1), ("unchanged", 1), ("new", 1)}
    assert stored.QUERIES["snapshot_change_counts"](spark, str(tmp_path)).columns == ["snapshot_no", "change", "n"]


def test_without_cached_lines_takes_out_listed_lines_only(spark, tmp_path):
    legal, own = "We are an equal opportunity employer", "A line that only this one posting has, number 0"
    listed = spark.range(1).select(tx.line_hash(F.lit(legal))).first()[0]
    documents = [(f"{b}{i}", b, f"{own}\n{legal}\nshort") for b in ("listed", "null", "empty", "holes", "unlisted") for i in range(4)] + [("none", None, legal), ("blank", "listed", None)]
    spark.createDataFrame(documents, "doc_id string, board_token string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    boards = [("listed", [listed]), ("listed", None), ("null", None), ("empty", []), ("holes", [None]), (None, [listed])]
    spark.createDataFrame(boards, "board_token string, boilerplate_hashes array<string>").write.parquet(f"{tmp_path}/pipeline_companies.parquet")
    got = {x["doc_id"]: x["n_chars"] for x in stored.QUERIES["without_cached_lines"](spark, str(tmp_path)).collect()}
    assert got == {d: len(f"{own}\nshort" if b == "listed" else t) for d, b, t in documents if t is not None}
    computed = {x["doc_id"]: x["n_chars"] for x in stored.QUERIES["without_board_lines"](spark, str(tmp_path)).collect()}
    assert computed["unlisted0"] < got["unlisted0"] and computed["listed0"] == got["listed0"]


def test_recommendations_are_of_the_24_nearest_of_all(spark, tmp_path):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    near = [(k, at(k), [None, "a", "own", "b"][k % 4] if k > 3 else None) for k in range(1, 25)]
    spark.createDataFrame([(0, at(0), "own"), *near, (25, at(60), "own"), (40, at(-70), "far"), (41, at(-71), "far")], "vec_id bigint, embedding array<float>, label string").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(x["query_id"], x["rank"]): x["id"] for x in stored.QUERIES["recommendations"](spark, str(tmp_path)).collect()}
    assert [got[0, k] for k in (1, 2, 3)] == [6, 1, 5]


def test_recommendations_leave_out_own_rows_beyond_the_24_nearest(spark, tmp_path):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    rows = [(0, at(0), "own")] + [(k, at(k), f"other{k % 7}") for k in range(1, 31)] + [(31, at(60), "own")]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string").write.parquet(f"{tmp_path}/embeddings.parquet")
    both = [{(x["query_id"], x["rank"]): x["id"] for x in stored.QUERIES[n](spark, str(tmp_path)).collect()} for n in ("recommendations", "owner_recommendations")]
    assert [[got[0, k] for k in (1, 2, 3)] for got in both] == [[1, 2, 3], [31, 1, 2]]
