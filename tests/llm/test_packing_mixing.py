import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import mixing, packing, tokens

SIZES = "doc bigint, tokens bigint, piece string, way string"


def placed_one_by_one(items, capacity):
    room = []
    for size in sorted(items, reverse=True):
        fits = [r for r in room if r >= size]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - size)
        else:
            room.append(capacity - size)
    return sorted(room)


def rows(spark, items, capacity):
    df = spark.createDataFrame([(i, n, "x", "y") for i, n in items], SIZES)
    return packing.packed(df, capacity).collect()


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_same_as_placing_every_item(spark, capacity):
    r = random.Random(capacity)
    items = [(i, r.randrange(0, 3 * capacity)) for i in range(150)] + [(200, None), (201, 50 * capacity + 3), (0, 1), (0, 1)]
    got = rows(spark, items, capacity)
    load = Counter()
    for x in got:
        if x["container"] is not None:
            load[x["container"]] += x["tokens"]
    pieces = [p for _, n in items if n for p in [capacity] * (n // capacity) + [n % capacity] if p]
    assert sorted(capacity - v for v in load.values()) == placed_one_by_one(pieces, capacity)
    assert set(load) == set(range(len(load)))
    whole = Counter()
    for x in got:
        whole[x["doc"]] += x["tokens"]
        assert x["first_token"] == x["piece"] * capacity
    want = Counter()
    for d, n in items:
        want[d] += n or 0
    assert whole == want
    assert all(x["container"] is None for x in got if x["tokens"] == 0)


def test_hot_size_and_empty(spark):
    got = rows(spark, [(i, 3) for i in range(500)], 10)
    assert Counter(Counter(x["container"] for x in got).values()) == {3: 166, 2: 1}
    assert rows(spark, [], 10) == []
    with pytest.raises(ValueError):
        rows(spark, [], 0)


def test_large_capacity_and_split_sizes(spark, monkeypatch):
    monkeypatch.setattr(packing, "WAY", 7)
    capacity = 1 << 22
    items = [(i, n) for i, n in enumerate([600_000] * 40 + [capacity] * 25 + [3 * capacity + 5, 1, capacity - 1])]
    load = Counter()
    for x in rows(spark, items, capacity):
        load[x["container"]] += x["tokens"]
    pieces = [n for _, n in items[:-3]] + [capacity] * 3 + [5, 1, capacity - 1]
    assert sorted(capacity - v for v in load.values()) == placed_one_by_one(pieces, capacity)


def test_filling(spark):
    out = packing.filling(packing.packed(spark.createDataFrame([(1, 6, "", ""), (2, 6, "", "")], SIZES), 10), 10).first()
    assert (out["containers"], out["tokens"], out["least_containers"], out["filled"]) == (2, 12, 2, 0.6)


def mix(spark, sizes, targets, **options):
    s = spark.createDataFrame([(*x, "c", 1) for x in sizes], "doc bigint, source string, tokens bigint, number string, block int")
    t = spark.createDataFrame(targets, "source string, weight double, max_repeats int")
    return mixing.Mix(s, t, **options)


def test_shares_caps_and_repeats(spark):
    r = random.Random(1)
    sizes = [(i, "big", r.randrange(1, 60)) for i in range(3000)] + [(10_000 + i, "mid", r.randrange(1, 60)) for i in range(700)] + [(20_000 + i, "small", 10) for i in range(20)] + [(30_000, "other", 50), (30_001, None, 5), (30_002, "big", None), (30_003, "big", 0)]
    m = mix(spark, sizes, [("big", 2.0, 1), ("mid", 1.0, 3), ("small", 0.5, 2), ("none", 1.0, 2), (None, 1.0, 1), ("mid", None, None)], total=60_000)
    chosen = m.chosen.collect()
    assert max(Counter((x["doc"], x["source"]) for x in chosen).values()) <= 3 and len({(x["doc"], x["repeat"]) for x in chosen}) == len(chosen)
    share = {x["source"]: x for x in m.shares().collect()}
    assert 400 - mixing.MOST_BLOCK < share["small"]["tokens"] <= 400 and share["small"]["repeats"] == 2
    assert abs(share["big"]["share_reached"] - share["big"]["share_possible"]) < 0.005 and abs(share["mid"]["share_reached"] - share["mid"]["share_possible"]) < 0.005
    assert share["none"]["tokens"] == 0 and set(share) == {"big", "mid", "small", "none"}
    # every stretch of the schedule holds the shares
    slots = max(x["slot"] for x in chosen) + 1
    first = sum(x["tokens"] for x in chosen if x["slot"] < slots // 4 and x["source"] == "big") / sum(x["tokens"] for x in chosen if x["slot"] < slots // 4)
    assert abs(first - share["big"]["share_reached"]) < 0.03


def test_same_result_again_and_empty_tables(spark):
    sizes, targets = [(i, "ab"[i % 2], 7) for i in range(100)], [("a", 1.0, 1), ("b", 3.0, 1)]
    assert sorted(map(tuple, mix(spark, sizes, targets).chosen.collect())) == sorted(map(tuple, mix(spark, sizes, targets).chosen.collect()))
    assert mix(spark, [], targets).chosen.count() == 0 and mix(spark, sizes, []).chosen.count() == 0
    assert mix(spark, sizes, [("a", -1.0, 1), ("b", float("nan"), 2)]).chosen.count() == 0


def test_quotas():
    assert mixing.quotas(np.array([1.0, 1.0, 2.0]), np.array([10.0, 100.0, 1000.0]), 100).round(6).tolist() == [10, 30, 60]
    assert mixing.quotas(np.array([1.0, 1.0]), np.array([10.0, 20.0]), 100).tolist() == [10, 20]


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "a" * 5000)], "doc bigint, text string")
    got = {r["doc"]: r["tokens"] for r in tokens.token_counts(df, ["doc"]).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 100
