import numpy as np

from millrace.operators.regions import Index, containing, trapezoids

POINTS = "id bigint, lat double, lng double, band int"
REGIONS = "id bigint, ring array<struct<lat:double,lng:double>>, part int"


def inside(lat, lng, ring):
    hit = False
    for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
        if (a > lat) != (c > lat) and lng >= b + (d - b) * (lat - a) / (c - a):
            hit = not hit
    return hit


def pairs(spark, points, regions):
    p = spark.createDataFrame([(*x, 1) for x in points], POINTS)
    r = spark.createDataFrame([(i, ring, 1) for i, ring in regions], REGIONS)
    return {tuple(x) for x in containing(p, r).collect()}


def test_brute_force(spark):
    rng = np.random.default_rng(2)
    regions = []
    for i in range(40):
        lat, lng = rng.uniform(-60, 60), rng.uniform(-150, 150)
        turn = np.sort(rng.uniform(0, 2 * np.pi, rng.integers(3, 12)))
        size = rng.uniform(0.2, 12, len(turn))
        regions.append((i, [(float(lat + s * np.sin(t)), float(lng + s * np.cos(t))) for s, t in zip(size, turn)]))
    points = [(k, float(a), float(b)) for k, (a, b) in enumerate(zip(rng.uniform(-70, 70, 3000), rng.uniform(-165, 165, 3000)))]
    corner = [(5000 + i, r[0][0], r[0][1] + 0.001) for i, r in regions]
    want = {(k, i) for k, a, b in points + corner for i, r in regions if inside(a, b, r)}
    assert len(want) > 50 and pairs(spark, points + corner, regions) == want


def test_squares_holes_nulls_and_empty(spark):
    square = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]
    hole = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
    points = [(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 5.0, 1.0), (4, None, 1.0), (5, 0.5, 0.0)]
    assert pairs(spark, points + points[:1], [(7, square), (7, hole), (8, None), (9, [(0.0, 0.0)])]) == {(1, 7), (5, 7)}
    assert pairs(spark, [], [(7, square)]) == set() and pairs(spark, points, []) == set()


def test_hot_cell_is_split_on_both_sides(spark, monkeypatch):
    from millrace.operators import near, regions

    monkeypatch.setattr(near, "ROOM", 60)
    monkeypatch.setattr(regions, "REGIONS", 20)
    rng = np.random.default_rng(6)
    boxes = [(i, [(10 + a, 20 + b), (10 + a, 20.2 + b), (10.1 + a, 20.2 + b), (10.1 + a, 20 + b)]) for i, (a, b) in enumerate(zip(rng.uniform(0, 0.3, 70).tolist(), rng.uniform(0, 0.5, 70).tolist()))]
    points = [(k, 10 + a, 20 + b) for k, (a, b) in enumerate(zip(rng.uniform(0, 0.5, 150).tolist(), rng.uniform(0, 0.9, 150).tolist()))]
    assert pairs(spark, points, boxes) == {(k, i) for k, a, b in points for i, r in boxes if inside(a, b, r)}


def test_trapezoids_grow_in_proportion():
    rng = np.random.default_rng(1)
    for n in (500, 4000, 32_000):
        lat, lng, size = rng.uniform(10, 10.4, n), rng.uniform(20, 21, n), rng.uniform(0.001, 0.1, n)
        turn = [0.1, 1.7, 3.0, 4.6]
        corner = [(lat + size * np.sin(t), lng + size * np.cos(t)) for t in turn]
        edges = [np.concatenate(x) for x in zip(*((np.arange(n), *corner[k], *corner[(k + 1) % 4]) for k in range(4)))]
        found = trapezoids(*edges, 10.0, 10.5)
        index = Index(*found)
        assert len(found[0]) <= 3 * n and len(index.slab) <= 12 * n
