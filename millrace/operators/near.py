"""Points near other points.

Method: trapezoidal decomposition.  The region within a distance of a place has two boundary edges,
west and east, which are functions of latitude.  The sphere is cut into cells (bands of latitude by
sectors of longitude), and each cell into slabs of equal height, a few to a region's height, so that a region crosses
few of them however many regions there are.  In a slab a region lies within a trapezoid between its two edges; the
trapezoids of a slab are ordered by their west edge; a point finds its slab, and in it the trapezoids
it may lie in, by binary search, and an exact distance decides.

Points go to one cell each, regions to every cell they touch.  A cell with many points or many regions is cut into
parts of either, and every part of its points meets every part of its regions by itself, so no task holds more than
its share of a hot place on either side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.scratch import cut

EARTH_KM = 6371.0088
#: Height and width of a cell in degrees (at least), and points and regions of a cell that one part takes.
BAND, SECTOR, ROOM, REGIONS = 0.5, 1.0, 200_000, 100_000
#: Slabs to a region's height, and to a cell's at most.
_FINE, _SLABS = 4, 4096
_EPS = 1e-7


def usable(lat: Column, lng: Column) -> Column:
    """Both present, not NaN, in range and not both 0."""
    return lat.isNotNull() & lng.isNotNull() & ~F.isnan(lat) & ~F.isnan(lng) & (F.abs(lat) <= 90) & (F.abs(lng) <= 180) & ~((lat == 0) & (lng == 0))


def distance_km(lat1: np.ndarray, lng1: np.ndarray, lat2: np.ndarray, lng2: np.ndarray) -> np.ndarray:
    """Great-circle distance on a sphere of radius EARTH_KM."""
    a, b = np.radians(lat1), np.radians(lat2)
    s = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lng2 - lng1) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(1.0, s)))


def half_widths(lat: np.ndarray, low: np.ndarray, high: np.ndarray, radius: float) -> np.ndarray:
    """Degrees of longitude between a region's centre and its edge, the most within latitudes low..high."""
    c, d = np.radians(lat), radius / EARTH_KM
    widest = np.degrees(np.arcsin(np.clip(np.sin(c) / math.cos(d), -1, 1)))
    at = np.radians(np.clip(np.clip(widest, low, high), lat - np.degrees(d), lat + np.degrees(d)))
    at = np.clip(at, -math.pi / 2 + 1e-12, math.pi / 2 - 1e-12)
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (math.cos(d) - np.sin(at) * np.sin(c)) / (np.cos(at) * np.cos(c))
    w = np.degrees(np.arccos(np.clip(np.nan_to_num(x, nan=-1.0), -1, 1)))
    pole = (np.abs(lat) + math.degrees(d) >= 90) | (np.abs(lat) >= 90)
    return np.where(pole, 360.0, w)


class Slabs:
    """The trapezoids of some regions within latitudes low..high."""

    def __init__(self, lat: np.ndarray, lng: np.ndarray, radius: float, low: float, high: float) -> None:
        tall = math.degrees(radius / EARTH_KM) + _EPS
        self.many = max(len(lat), 1)
        bottom, top = np.maximum(lat - tall, low - _EPS), np.minimum(lat + tall, high + _EPS)
        slabs = int(min(max(1, math.ceil((high - low) / (2 * tall / _FINE))), _SLABS))
        self.cuts = np.linspace(low - _EPS, high + _EPS, slabs + 1)
        first = np.maximum(np.searchsorted(self.cuts, bottom, "right") - 1, 0)
        last = np.minimum(np.searchsorted(self.cuts, top, "left"), slabs)
        many = np.maximum(last - first, 0)
        region = np.repeat(np.arange(len(lat)), many)
        slab = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[region]
        w = half_widths(lat[region], self.cuts[slab], self.cuts[slab + 1], radius) + _EPS
        west, east = lng[region] - w, lng[region] + w
        # a trapezoid across the date line, or around a pole, stands there again one turn on
        more = [(slab, west, east, region)]
        for turn in (-360.0, 360.0):
            again = (east + turn >= -180) & (west + turn <= 180)
            more.append((slab[again], west[again] + turn, east[again] + turn, region[again]))
        slab, west, east, region = (np.concatenate(x) for x in zip(*more))
        order = np.lexsort((west, slab))
        self.slab, self.west, self.east, self.region = slab[order], west[order], east[order], region[order]
        self.start = np.searchsorted(self.slab, np.arange(len(self.cuts) + 1))
        self.wide = np.zeros(len(self.cuts) + 1)
        np.maximum.at(self.wide, self.slab, self.east - self.west)
        self.key = self.slab * 4096.0 + (self.west + 1024.0)

    def candidates(self, lat: np.ndarray, lng: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, region) for all trapezoids that hold a point: by binary search among the slab's west edges."""
        slab = np.clip(np.searchsorted(self.cuts, lat, "right") - 1, 0, len(self.cuts) - 2)
        first = np.maximum(np.searchsorted(self.key, slab * 4096.0 + (lng - self.wide[slab] + 1024.0) - _EPS, "left"), self.start[slab])
        last = np.minimum(np.searchsorted(self.key, slab * 4096.0 + (lng + 1024.0) + _EPS, "right"), self.start[slab + 1])
        many = np.maximum(last - first, 0)
        point = np.repeat(np.arange(len(lat)), many)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[point]
        inside = self.east[at] >= lng[point]
        # a region around a pole may hold a point in two of its turns
        pair = np.unique(point[inside] * self.many + self.region[at[inside]])
        return pair // self.many, pair % self.many


def met(batches: Iterator[pa.RecordBatch], values: list[str], build: Callable, locate: Callable, step: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Points of each part of a cell located in what is built of the rows before them.

    Rows come sorted by band, sector, part, other and is_point; ``build`` takes a part's region rows (a list of
    columns) and the band, ``locate`` what was built and a stretch of points.
    """
    keys = ("band", "sector", "part", "other", "is_point")
    key: tuple | None = None
    held: list[list[np.ndarray]] = []
    built = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        own = [batch.column(c).to_numpy(zero_copy_only=False) for c in values]
        for a, b in zip(edges[:-1], edges[1:]):
            now = tuple(int(c[a]) for c in cols[:4])
            if now != key:
                key, held, built = now, [], None
            if not cols[4][a]:
                held.append([v[a:b] for v in own])
                continue
            if not held:
                continue
            if built is None:
                built = build([np.concatenate(x) for x in zip(*held)], now[0])
            for s in range(a, b, step):
                yield locate(built, [v[s : min(b, s + step)] for v in own])


def in_parts(points: DataFrame, regions: DataFrame, values: list[str], regions_a_part: int) -> DataFrame:
    """Points and regions (band, sector, id, ``values``) of cells that have both, dealt to parts, together and in order.

    Points get nulls for the values they lack.
    """
    cell = ["band", "sector"]
    size = lambda rows, room, name: rows.groupBy(*cell).agg(F.ceil(F.count("*") / room).cast("int").alias(name))
    parts = size(points, ROOM, "parts").join(size(regions, regions_a_part, "others"), cell)
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    p = points.join(parts, cell).withColumn("part", F.pmod(F.xxhash64("id", "lat", "lng"), F.col("parts")).cast("int")).withColumn("other", every("others"))
    q = regions.join(parts, cell).withColumn("other", F.pmod(F.xxhash64("id", *values), F.col("others")).cast("int")).withColumn("part", every("parts"))
    keys = [*cell, "part", "other"]
    own = lambda rows, is_point: rows.select(*keys, F.lit(is_point).alias("is_point"), "id", *[c if c in rows.columns else F.lit(None).cast("double").alias(c) for c in dict.fromkeys(["lat", "lng", *values])])
    return own(q, 0).unionByName(own(p, 1)).repartition(*keys).sortWithinPartitions(*keys, "is_point")


def usable_points(points: DataFrame, row: Callable[[Column], Column], column: Callable[[Column], Column]) -> DataFrame:
    """Points with id and usable coordinates, each once, in their cells."""
    good = points.select("id", "lat", "lng").filter(usable(F.col("lat"), F.col("lng")) & F.col("id").isNotNull()).distinct()
    return cut(good.select("id", "lat", "lng", row(F.col("lat")).alias("band"), column(F.col("lng")).alias("sector")), "points")


def several_places(rows: DataFrame) -> bool:
    """Whether an id stands at more than one place."""
    return not rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def near(points: DataFrame, places: DataFrame, radius_km: float) -> DataFrame:
    """Pairs (point_id, place_id, km) at most ``radius_km`` apart.

    points, places: (id bigint, lat double, lng double).  Rows without id or usable coordinates find
    nothing; repeated rows count once; of an id at several places the least distance counts; a point at a place's own
    position is near it.  Either table may be empty.
    """
    if not 0 < radius_km < EARTH_KM:
        raise ValueError("radius_km must be positive and less than the earth's radius")
    tall = math.degrees(radius_km / EARTH_KM) + _EPS
    band, sector = max(BAND, 2 * tall), SECTOR
    lat, lng = F.col("lat"), F.col("lng")
    bands, sectors = math.ceil(180 / band), math.ceil(360 / sector)
    row = lambda x: F.least(F.floor((x + 90) / band), F.lit(bands - 1)).cast("int")
    column = lambda x: F.least(F.floor((x + 180) / sector), F.lit(sectors - 1)).cast("int")
    p = usable_points(points, row, column)
    q = cut(places.select("id", "lat", "lng").filter(usable(lat, lng) & F.col("id").isNotNull()).distinct(), "places")
    ratio = F.lit(math.sin(radius_km / EARTH_KM)) / F.greatest(F.cos(F.radians(lat)), F.lit(1e-12))
    width = F.when((F.abs(lat) + tall >= 90) | (ratio >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + _EPS)
    low, high = F.floor((lng - width + 180) / sector).cast("int"), F.floor((lng + width + 180) / sector).cast("int")
    high = F.least(high, low + sectors - 1)
    cells = q.withColumn("band", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((lat - tall + 90) / band).cast("int")), F.least(F.lit(bands - 1), F.floor((lat + tall + 90) / band).cast("int"))))).withColumn("sector", F.explode(F.transform(F.sequence(low, high), lambda s: F.pmod(s, F.lit(sectors)))))

    def build(regions: list[np.ndarray], number: int) -> tuple[Slabs, list[np.ndarray]]:
        return Slabs(regions[1], regions[2], radius_km, -90 + number * band, -90 + (number + 1) * band), regions

    def locate(built: tuple[Slabs, list[np.ndarray]], own: list[np.ndarray]) -> pa.RecordBatch:
        slabs, (ids, at, along) = built
        p, r = slabs.candidates(own[1], own[2])
        d = distance_km(own[1][p], own[2][p], at[r], along[r])
        ok = d <= radius_km
        return pa.RecordBatch.from_arrays([pa.array(own[0][p[ok]]), pa.array(ids[r[ok]]), pa.array(d[ok])], names=["point_id", "place_id", "km"])

    found = in_parts(p, cells, ["lat", "lng"], REGIONS).mapInArrow(lambda batches: met(batches, ["id", "lat", "lng"], build, locate), "point_id bigint, place_id bigint, km double")
    # a point lies in one cell and one part, and meets each place once: only ids at several places can repeat a pair
    return found.groupBy("point_id", "place_id").agg(F.min("km").alias("km")) if several_places(p) or several_places(q) else found
