import numpy as np
import pytest

from millrace import bloom


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_narrowed_keeps_all_wanted_rows(spark, most):
    rows = spark.createDataFrame([(f"k{i}", i, 1) for i in range(5000)] + [(None, 1, 1)], "id string, n bigint, _h int")
    keys = spark.createDataFrame([(f"k{i}",) for i in range(0, 5000, 50)], "id string")
    out = bloom.narrowed(rows, "id", keys, most)
    got = [r["id"] for r in out.collect()]
    assert out.columns == rows.columns or set(out.columns) == set(rows.columns)
    assert {f"k{i}" for i in range(0, 5000, 50)} <= set(got) and len(got) < 400


def test_filter_size_follows_the_number_of_keys():
    rng = np.random.default_rng(0)
    for n in (100, 20_000):
        bits = bloom.bits_for(n)
        h, other = (rng.integers(-(2**63), 2**63 - 1, n) for _ in range(2))
        words = np.zeros(1 << (bits - 6), np.int64)
        at = bloom.places(h, bits).ravel()
        np.bitwise_or.at(words, at >> 6, np.left_shift(np.int64(1), at & 63))
        assert bloom.held(words, h, bits).all() and bloom.held(words, other, bits).mean() < 0.02


def test_no_filter_beyond_the_largest(spark, monkeypatch):
    monkeypatch.setattr(bloom, "LARGEST", 10)
    rows = spark.range(100).withColumnRenamed("id", "k")
    assert bloom.narrowed(rows, "k", rows.limit(3), 0).count() == 100
