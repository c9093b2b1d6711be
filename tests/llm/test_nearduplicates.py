import itertools
import random

import numpy as np
import pytest

from millrace.llm import nearduplicates as nd

SCHEMA = "id string, raw string, no string, a string, band string"


def words(text, n):
    w = nd.WORD.findall((text or "").lower())
    return set(zip(*(w[k:] for k in range(n))))


def expected(rows, n, t):
    sets = {i: words(x, n) for i, x in rows if i is not None}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}


def similar(spark, rows, **options):
    return nd.Similar(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA), **options)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([8, 40, 150]))] for _ in range(40)]
    rows = []
    for n, b in enumerate(base):
        rows.append((f"d{n}", " ".join(b)))
        for k in range(3):
            own = list(b)
            for _ in range(r.randrange(0, max(1, len(own) // 12))):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((f"d{n}-{k}", " ".join(own)))
    return rows


@pytest.mark.parametrize("n, threshold", [(3, 0.6), (5, 0.8)])
def test_pairs_match_brute_force(spark, n, threshold):
    rows = corpus(n) + [(None, "a b c d e f"), ("null", None), ("empty", ""), ("few", "a b"), ("long", "z " * 60_000)]
    rows += rows[:5]
    assert {tuple(r) for r in similar(spark, rows, n=n, threshold=threshold).pairs().collect()} == expected(rows, n, threshold)


def test_large_buckets_go_block_by_block(spark, monkeypatch):
    rows = [(f"c{i:03d}", " ".join(f"t{k}" for k in range(80)) + f" own{i} end{i}") for i in range(90)]
    plan = spark.createDataFrame([(7, i) for i in range(90)] + [(8, 5), (8, 3), (9, 1)], "band bigint, no bigint").repartition(1).sortWithinPartitions("band")
    parts = plan.mapInArrow(nd._split_large(20), "band bigint, no bigint, block int, a bigint, b bigint").collect()
    assert {(r["a"], r["b"]) for r in parts if r["band"] is None} == {(3, 5)} and sorted(r["no"] for r in parts if r["band"] == 7) == list(range(90))
    monkeypatch.setattr(nd.proposed, "__defaults__", (20,))
    got = {tuple(r) for r in similar(spark, rows, n=3, threshold=0.6).pairs().collect()}
    assert got == set(itertools.combinations([i for i, _ in rows], 2))


def test_empty_table(spark):
    assert similar(spark, [], n=3, threshold=0.6).pairs().count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    a, b = x[:300], x[100:]
    assert (np.minimum(nd.minima(a, 512), nd.minima(b, 512)) == nd.minima(x, 512)).all()
    guesses = []
    for _ in range(50):
        x = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
        p, q = nd.registers(x[:400], 768), nd.registers(x[100:], 768)
        up, down = (p > q).sum(), (p < q).sum()
        guesses.append(nd.likeliest(np.array([up]), np.array([down]), np.array([768 - up - down]), np.array([400.0]), np.array([400.0]))[0])
    assert abs(np.mean(guesses) - 0.6) < 0.01 and np.std(guesses) < 0.03
