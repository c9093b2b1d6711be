import random

import numpy as np
from pyspark.sql import functions as F

from millrace.operators import snapshots as sn

SCHEMA = "id string, snapshot_no int, delivered_at int, content_hash string, removed_at int, key string, bucket string, pair string"


def changes(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    out = sn.snapshot_changes(df, "id", "snapshot_no", "delivered_at", F.lower(F.trim("content_hash")), F.col("removed_at").isNull())
    return {tuple(r) for r in out.collect()}


def expected(rows):
    state = {}
    for i, k, d, h, gone in rows:
        if i is None or k is None:
            continue
        new = (-1 if d is None else d, gone is None, h is not None, (h or "").strip().lower(), h)
        old = state.get((i, k))
        if old is None or new[:2] > old[:2]:
            state[(i, k)] = new
    numbers = {k for _, k, *_ in rows if k is not None}
    live = {k: {i: (v[2], v[3]) for (i, n), v in state.items() if n == k and v[1]} for k in numbers}
    out = set()
    for before, k in zip(sorted(numbers), sorted(numbers)[1:]):
        for i in live[k] | live[before]:
            a, b = live[before].get(i), live[k].get(i)
            if a != b:
                out.add((i, k, "added" if a is None else "removed" if b is None else "changed"))
    return out


def test_changes_match_brute_force(spark):
    r = random.Random(5)
    rows = [(f"j{i}", k, r.randrange(50) * 1000 + n, r.choice(["A", "a ", "b", None]), r.choice([None, None, 3])) for n, (i, k) in enumerate((r.randrange(300), r.randrange(1, 5)) for _ in range(1500))]
    assert changes(spark, rows) == expected(rows)


def test_repeated_late_null_and_missing_numbers(spark):
    rows = [("a", 1, 5, "h", None), ("a", 1, 5, "h", None), ("a", 1, 9, "H ", None), ("a", 2, None, "x", None), ("a", 2, 1, "h", None), (None, 1, 1, "h", None), ("b", None, 1, "h", None), ("c", 1, 1, None, None), ("c", 2, 1, None, None), ("d", 4, 1, "q", None), ("d", 2, 1, "", None), ("d", 1, 1, None, None)]
    assert changes(spark, rows) == {("d", 2, "changed"), ("d", 4, "changed"), ("a", 4, "removed"), ("c", 4, "removed")}


def test_empty_and_single_snapshot(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [("a", 3, 1, "h", None)]) == set()


def test_small_tables_are_enlarged():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, 3000).astype(np.uint64)
    n = len(keys)
    live = [rng.random(n) < 0.8 for _ in range(3)]
    value = [rng.integers(0, 3, n).astype(np.uint64) for _ in range(3)]
    for cells in (0.01, 0.5, 3.0):
        for k, (place, kind) in enumerate(sn.bucket_changes(keys, list(zip(live, value)), cells), 1):
            a, b, same = live[k - 1], live[k], value[k - 1] == value[k]
            want = np.select([a & b & ~same, b & ~a, a & ~b], [2, 0, 1], -1)
            assert (place == np.flatnonzero(want >= 0)).all() and (kind == want[want >= 0]).all()


def test_keys_of_one_hash_and_many_snapshots(spark, monkeypatch):
    keys = np.array([5, 5, 7], np.uint64)
    batch = __import__("pyarrow").RecordBatch.from_pydict({"id": ["a", "b", "c"], "key": keys.view(np.int64), "live0": [True, True, True], "value0": [1, 1, 1], "live1": [True, False, True], "value1": [2, 0, 1]})
    out = [r for b in sn._compared([3, 9], 10)(iter([batch])) for r in b.to_pylist()]
    assert sorted((r["id"], r["snapshot"], r["change"]) for r in out) == [("a", 9, "changed"), ("b", 9, "removed")]
    r = random.Random(8)
    rows = [(f"j{i}", k, 1, r.choice("ab"), None) for i in range(40) for k in (1, 2, 4, 7, 8, 9) if r.random() < 0.8]
    monkeypatch.setattr(sn, "PASS", 3)
    assert changes(spark, rows) == expected(rows)


def test_hashes_equal_sparks(spark):
    values = [0, 1, -1, 2**62, -(2**63)]
    df = spark.createDataFrame([(v, -v if v > -(2**63) else 5) for v in values], "a bigint, b bigint")
    for salt in (0, 1, 77):
        rows = df.select("a", "b", F.xxhash64("a", "b", F.lit(salt)).alias("h")).collect()
        a, b = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in ("a", "b"))
        assert sn._salted(a, b, salt).view(np.int64).tolist() == [r["h"] for r in rows]
