import numpy as np
import pandas as pd
import pytest

from millrace.operators.near import distance_km, near

SCHEMA = "id bigint, lat double, lng double, band int, sector int, part int"


def pairs(spark, points, places, radius):
    f = lambda rows: spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    return {(r["point_id"], r["place_id"]) for r in near(f(points), f(places), radius).collect()}


@pytest.mark.parametrize("radius", [25.0, 400.0, 3000.0])
def test_brute_force_with_poles_and_date_line(spark, radius):
    rng = np.random.default_rng(3)
    n = 400
    lat = np.degrees(np.arcsin(rng.uniform(-1, 1, n)))
    lat[:60], lat[60:90] = rng.uniform(88, 90, 60), rng.uniform(-90, -89, 30)
    lng = rng.uniform(-180, 180, n)
    lng[90:160] = rng.choice([-180, 180, 179.99, -179.95], 70)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lng))]
    places = [(i, float(np.clip(a + rng.uniform(-0.1, 0.1), -90, 90)), b) for i, a, b in points[::2]]
    p = pd.DataFrame(places).values
    want = {(i, int(j)) for i, a, b in points for j in p[distance_km(a, b, p[:, 1], p[:, 2]) <= radius, 0]}
    assert pairs(spark, points, places, radius) == want


def test_unusable_repeated_and_empty(spark):
    good = (1, 10.0, 20.0)
    bad = [(2, None, 20.0), (3, float("nan"), 1.0), (4, 91.0, 0.0), (5, 0.0, 0.0), (6, 0.0, 181.0), (None, 10.0, 20.0)]
    assert pairs(spark, [good, good, *bad], [(7, 10.0, 20.0), (7, 10.0, 20.0), *bad], 25.0) == {(1, 7)}
    assert pairs(spark, [], [good], 25.0) == set()
    assert pairs(spark, [good], [], 25.0) == set()


def test_hot_place_is_split(spark, monkeypatch):
    from millrace.operators import near as module

    monkeypatch.setattr(module, "ROOM", 50)
    assert len(pairs(spark, [(i, 10.0, 20.0 + i * 1e-5) for i in range(400)], [(1, 10.0, 20.0), (2, 10.1, 20.0)], 25.0)) == 800


def test_both_sides_of_a_hot_place_are_split(spark, monkeypatch):
    from millrace.operators import near as module

    monkeypatch.setattr(module, "ROOM", 70)
    monkeypatch.setattr(module, "REGIONS", 30)
    points = [(i, 10.0 + i * 1e-5, 20.0) for i in range(200)]
    assert len(pairs(spark, points, [(i, 10.0, 20.0 + i * 1e-5) for i in range(90)], 25.0)) == 200 * 90


def test_an_id_at_several_places_counts_once(spark):
    f = lambda rows: spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    out = near(f([(1, 10.0, 20.0), (1, 10.1, 20.0)]), f([(7, 10.1, 20.0), (7, 10.15, 20.0)]), 25.0).collect()
    assert [(r["point_id"], r["place_id"], round(r["km"], 6)) for r in out] == [(1, 7, 0.0)]


def test_trapezoids_grow_in_proportion():
    from millrace.operators.near import Slabs

    rng = np.random.default_rng(1)
    each = []
    for n in (500, 4000, 32_000):
        lat, lng = rng.uniform(10, 10.5, n), rng.uniform(20, 21, n)
        each.append(len(Slabs(lat, lng, 25.0, 10.0, 10.5).slab) / n)
        each.append(len(Slabs(lat, lng, 0.2, 10.0, 10.5).slab) / n)
    assert max(each) < 7
