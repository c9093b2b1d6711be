import numpy as np

from millrace.operators import recommend
from millrace.plans import catalogue


def test_own_owner_is_searched_beyond_the_nearest_of_all(spark, tmp_path):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    rows = [(0, at(0), "own")] + [(k, at(k), f"other{k % 7}") for k in range(1, 31)] + [(31, at(60), "own"), (32, at(50), "own")]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(x["query_id"], x["rank"]): x["id"] for x in catalogue.recommendations(spark, str(tmp_path)).collect()}
    assert [got[0, k] for k in (1, 2, 3)] == [32, 1, 2]


def test_nearest_within_a_column_equals_brute_force(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(90, 5)).astype(np.float32)
    owner = [None if i % 13 == 0 else "abc"[int(k)] for i, k in enumerate(r.integers(0, 3, 90))]
    df = spark.createDataFrame([(i, x[i].tolist(), owner[i]) for i in range(90)], "id bigint, vector array<float>, owner string")
    got = {(t["query_id"], t["rank"]): t["id"] for t in recommend.nearest(df.filter("id < 20"), df, 4, room=2, within="owner").collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for i in range(20):
        mine = [j for j in range(90) if j != i and owner[i] is not None and owner[j] == owner[i]]
        for k, j in enumerate(sorted(mine, key=lambda j: -float(unit[i] @ unit[j]))[:4]):
            want[i, k + 1] = j
    assert got == want


def test_boards_without_cached_lines_have_them_computed(spark, tmp_path):
    legal, own = "We are an equal opportunity employer", "A line that only this one posting has, number {}"
    documents = [(f"{b}{i}", b, "\n".join([own.format(i), legal, "short"])) for b in ("cached", "null", "empty", "unlisted") for i in range(4)]
    documents += [(f"two{i}", "two", f"{own.format(i)}\n{legal}") for i in range(2)] + [("none", None, legal), ("blank", "null", None)]
    documents += [(f"some{i}", "some", f"{own.format(i)}\n{legal}" if i < 2 else own.format(i)) for i in range(5)]
    spark.createDataFrame(documents, "doc_id string, board_token string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    first = spark.range(1).select(catalogue.tx.line_hash(catalogue.F.lit(own.format(0)))).first()[0]
    boards = [("cached", [first]), ("null", None), ("empty", []), ("two", None), ("some", None)]
    spark.createDataFrame(boards, "board_token string, boilerplate_hashes array<string>").write.parquet(f"{tmp_path}/pipeline_companies.parquet")
    got = {x["doc_id"]: x["n_chars"] for x in catalogue.without_cached_lines(spark, str(tmp_path)).collect()}
    kept = {"cached0": f"{legal}\nshort", **{f"{b}{i}": f"{own.format(i)}\nshort" for b in ("null", "empty", "unlisted") for i in range(4)}}
    assert got == {d: len(kept.get(d, text)) for d, _, text in documents if text is not None}


def test_every_pair_of_consecutive_snapshots_is_counted(spark, tmp_path):
    held = {1: {"a": "x", "b": "x"}, 2: {"a": "y", "b": "x", "c": None}, 3: {"c": None}, 5: {"d": "x"}, 6: {"d": "x", "e": "x"}}
    rows = [(i, n, h, None, None, None) for n, own in held.items() for i, h in own.items()] + [(None, 3, "x", None, None, None), ("z", None, "x", None, None, None)]
    spark.createDataFrame(rows, "id string, snapshot_no int, content_hash string, delivered_at timestamp, last_seen_at timestamp, title string").write.parquet(f"{tmp_path}/job_snapshots.parquet")
    got = {(x["snapshot_no"], x["change"]): x["n"] for x in catalogue.change_counts(spark, str(tmp_path)).collect()}
    assert got == {(2, "changed"): 1, (2, "unchanged"): 1, (2, "new"): 1, (3, "absent"): 2, (3, "unchanged"): 1, (6, "unchanged"): 1, (6, "new"): 1}
