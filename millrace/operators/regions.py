"""The region that contains a point, for regions bounded by polygons.

Method: trapezoidal decomposition.  In each band of latitude the latitudes of a region's own corners cut it into
trapezoids between two of its edges, which no corner interrupts.  Trapezoids are rows of their own and go to the cells
(band by sector of longitude) that they touch.  A cell's trapezoids are kept in slabs, as many as leave each of them in few
slabs, and ordered by their west edge: a point finds its slab and its trapezoids by binary search, and where it lies between
the two edges at its own latitude is decided exactly.  Points and trapezoids of a hot cell are dealt to parts as in ``near``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.near import BAND, REGIONS, SECTOR, in_parts, met, several_places, usable_points
from millrace.scratch import cut

#: Trapezoids to a slab that are aimed at, and slabs that hold a copy of a trapezoid, on average at most.
_SLAB, _COPIES = 16, 4
#: A trapezoid: its region, its lowest and highest latitude, and longitude and slope of its edges at the lowest.
VALUES = ["low", "high", "west", "west_slope", "east", "east_slope"]


def trapezoids(region: np.ndarray, lat1: np.ndarray, lng1: np.ndarray, lat2: np.ndarray, lng2: np.ndarray, low: float, high: float) -> list[np.ndarray]:
    """region and VALUES of the trapezoids of edges, within latitudes low..high."""
    up = lat1 <= lat2
    a_lat, a_lng, b_lat, b_lng = np.where(up, lat1, lat2), np.where(up, lng1, lng2), np.where(up, lat2, lat1), np.where(up, lng2, lng1)
    keep = (a_lat < b_lat) & (b_lat > low) & (a_lat < high)
    region, a_lat, a_lng, b_lat, b_lng = (x[keep] for x in (region, a_lat, a_lng, b_lat, b_lng))
    n = len(region)
    if not n:
        return [region, *[np.zeros(0)] * len(VALUES)]
    # the cuts of all regions in one array, region by region
    ends, owner = np.concatenate([np.maximum(a_lat, low), np.minimum(b_lat, high)]), np.concatenate([region, region])
    order = np.lexsort((ends, owner))
    new = np.concatenate([[True], (ends[order][1:] != ends[order][:-1]) | (owner[order][1:] != owner[order][:-1])])
    cuts, place = ends[order][new], np.empty(2 * n, np.int64)
    place[order] = np.cumsum(new) - 1
    many = place[n:] - place[:n]
    edge = np.repeat(np.arange(n), many)
    slab = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + place[:n][edge]
    slope = (b_lng - a_lng) / (b_lat - a_lat)
    at = lambda e, lat: a_lng[e] + slope[e] * (lat - a_lat[e])
    order = np.lexsort((at(edge, (cuts[slab] + cuts[slab + 1]) / 2), slab))
    slab, edge = slab[order], edge[order]
    # a region's edges in a slab, from west to east: the first and second bound a trapezoid, the third and fourth the next
    new = np.concatenate([[True], slab[1:] != slab[:-1]])
    within = np.arange(len(slab)) - np.maximum.accumulate(np.where(new, np.arange(len(slab)), 0))
    left = np.flatnonzero((within % 2 == 0) & ~np.append(new[1:], True))
    west, east, slab = edge[left], edge[left + 1], slab[left]
    return [region[west], cuts[slab], cuts[slab + 1], at(west, cuts[slab]), slope[west], at(east, cuts[slab]), slope[east]]


class Index:
    """Trapezoids in slabs, to be searched."""

    def __init__(self, region: np.ndarray, low: np.ndarray, high: np.ndarray, west: np.ndarray, west_slope: np.ndarray, east: np.ndarray, east_slope: np.ndarray) -> None:
        self.region, self.low, self.high, self.west, self.west_slope, self.east, self.east_slope = region, low, high, west, west_slope, east, east_slope
        n = len(region)
        slabs = max(1, n // _SLAB)
        while True:
            self.cuts = np.unique(np.concatenate([np.quantile(low, np.linspace(0, 1, slabs + 1)), [high.max()]])) if n else np.zeros(1)
            first = np.searchsorted(self.cuts, low, "right") - 1
            last = np.searchsorted(self.cuts, high, "left")
            many = np.maximum(last - first, 0)
            if slabs == 1 or many.sum() <= _COPIES * n:
                break
            slabs //= 2
        trapezoid = np.repeat(np.arange(n), many)
        slab = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[trapezoid]
        most_west = np.minimum(west, west + west_slope * (high - low))[trapezoid]
        most_east = np.maximum(east, east + east_slope * (high - low))[trapezoid]
        order = np.lexsort((most_west, slab))
        self.slab, self.trapezoid, self.most_west = slab[order], trapezoid[order], most_west[order]
        self.start = np.searchsorted(self.slab, np.arange(len(self.cuts) + 1))
        self.wide = np.zeros(len(self.cuts) + 1)
        np.maximum.at(self.wide, self.slab, most_east[order] - self.most_west)
        self.key = self.slab * 8192.0 + (self.most_west + 2048.0)

    def containing(self, lat: np.ndarray, lng: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, region): a point on a region's west or lower edge is inside, on its east or upper edge outside."""
        slab = np.clip(np.searchsorted(self.cuts, lat, "right") - 1, 0, max(0, len(self.cuts) - 2))
        first = np.maximum(np.searchsorted(self.key, slab * 8192.0 + (lng - self.wide[slab] + 2048.0) - 1e-9, "left"), self.start[slab])
        last = np.minimum(np.searchsorted(self.key, slab * 8192.0 + (lng + 2048.0) + 1e-9, "right"), self.start[slab + 1])
        many = np.maximum(last - first, 0)
        point = np.repeat(np.arange(len(lat)), many)
        t = self.trapezoid[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[point]]
        y, x = lat[point], lng[point]
        inside = (self.low[t] <= y) & (y < self.high[t]) & (self.west[t] + self.west_slope[t] * (y - self.low[t]) <= x) & (x < self.east[t] + self.east_slope[t] * (y - self.low[t]))
        return point[inside], self.region[t[inside]]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trapezoids of the edges of regions, which come sorted by band and region."""
    held: list[pa.RecordBatch] = []

    def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        band = t.column("band").to_numpy()
        for b in np.unique(band).tolist():
            own = band == b
            out = trapezoids(*(t.column(c).to_numpy()[own] for c in ("id", "lat", "lng", "lat2", "lng2")), -90 + b * BAND, -90 + (b + 1) * BAND)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out[0]), b, np.int32)), *map(pa.array, out)], names=["band", "id", *VALUES])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = (batch.column("band")[-1].as_py(), batch.column("id")[-1].as_py())
        last = (batch.column("band").to_numpy() == key[0]) & (batch.column("id").to_numpy() == key[1])
        start = int(np.argmax(last))  # the last region may go on in the next batch
        if start:
            yield from flush([*held, batch.slice(0, start)])
            held = []
        elif held and (held[-1].column("band")[-1].as_py(), held[-1].column("id")[-1].as_py()) != key:
            yield from flush(held)
            held = []
        held.append(batch.slice(start))
    if held:
        yield from flush(held)


def containing(points: DataFrame, regions: DataFrame) -> DataFrame:
    """Pairs (point_id, region_id) of points and the regions that they lie in.

    points: (id bigint, lat double, lng double); regions: (id bigint, ring array<struct<lat,lng>>), straight between
    corners in latitude and longitude, closed or not, not crossing the date line; several rings of one id are one region,
    rings within rings are holes.  Null or short rings contain nothing.  Regions may overlap; repeated points count once.
    """
    bands, sectors = math.ceil(180 / BAND), math.ceil(360 / SECTOR)
    row = lambda x: F.greatest(F.lit(0), F.least(F.floor((x + 90) / BAND), F.lit(bands - 1))).cast("int")
    column = lambda x: F.greatest(F.lit(0), F.least(F.floor((x + 180) / SECTOR), F.lit(sectors - 1))).cast("int")
    p = usable_points(points, row, column)
    good = regions.filter("id is not null and size(ring) >= 3").select("id", "ring")
    ring = good.select("id", F.when(F.element_at("ring", 1) == F.element_at("ring", -1), F.col("ring")).otherwise(F.concat("ring", F.slice("ring", 1, 1))).alias("r"))
    lines = ring.select("id", F.explode(F.arrays_zip(F.slice("r", F.lit(1), F.size("r") - 1).alias("a"), F.slice("r", F.lit(2), F.size("r") - 1).alias("b"))).alias("x")).select("id", F.col("x.a.lat").alias("lat"), F.col("x.a.lng").alias("lng"), F.col("x.b.lat").alias("lat2"), F.col("x.b.lng").alias("lng2"))
    low, high = F.least("lat", "lat2"), F.greatest("lat", "lat2")
    edges = lines.filter("lat <> lat2").withColumn("band", F.explode(F.sequence(row(low), row(high))))
    kinds = ", ".join(f"{v} double" for v in VALUES)
    split = edges.select("band", "id", "lat", "lng", "lat2", "lng2").repartition("band", "id").sortWithinPartitions("band", "id").mapInArrow(_split, f"band int, id bigint, {kinds}")
    tall = F.col("high") - F.col("low")
    west, east = F.least("west", F.col("west") + F.col("west_slope") * tall), F.greatest("east", F.col("east") + F.col("east_slope") * tall)
    cells = cut(split.withColumn("sector", F.explode(F.sequence(column(west), column(east)))), "trapezoids")

    def build(rows: list[np.ndarray], number: int) -> Index:
        return Index(rows[0], *rows[3:])

    def locate(built: Index, own: list[np.ndarray]) -> pa.RecordBatch:
        at, region = built.containing(own[1], own[2])
        return pa.RecordBatch.from_arrays([pa.array(own[0][at]), pa.array(region)], names=["point_id", "region_id"])

    found = in_parts(p, cells, VALUES, REGIONS).mapInArrow(lambda batches: met(batches, ["id", "lat", "lng", *VALUES], build, locate), "point_id bigint, region_id bigint")
    # a point meets each trapezoid once, and those of a region don't overlap
    return found.distinct() if several_places(p) else found
