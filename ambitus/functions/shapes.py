"""Planar and geodesic measures of points, lines and rings, as column expressions.

A coordinate is a struct (latitude, longitude); a line or ring is an array of them.  A frame is the point around which degrees
are turned into feet: x = (lon - lon0) * 364000 * cos(lat0), y = (lat - lat0) * 364000.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import EARTH_RADIUS_FEET, FEET_PER_DEGREE, haversine


def coord(lat: Column, lon: Column) -> Column:
    return F.struct(lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"))


def planar_feet(lat: Column, lon: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    return (lon - lon0) * FEET_PER_DEGREE * F.cos(F.radians(lat0)), (lat - lat0) * FEET_PER_DEGREE


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point from a segment; from its one point if both ends are the same."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.when(length == 0, F.lit(1.0)).otherwise(length))))
    return F.sqrt(F.pow(px - (ax + t * dx), 2) + F.pow(py - (ay + t * dy), 2))


def _pairs(points: Column) -> Column:
    """Neighbouring coordinates of a line as structs (a, b)."""
    n = F.size(points)
    return F.when(n < 2, F.array().cast("array<struct<a:struct<latitude:double,longitude:double>,b:struct<latitude:double,longitude:double>>>")).otherwise(
        F.zip_with(F.slice(points, 1, F.greatest(n - 1, F.lit(0))), F.slice(points, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    )


def closed(ring: Column) -> Column:
    """The ring with its first point again at the end, unless it is there."""
    return F.when((F.size(ring) > 0) & (ring[0] != F.element_at(ring, -1)), F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def line_distance(points: Column, lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Feet from a point to a line; to the point of a line of one; infinite for an empty line."""
    px, py = planar_feet(lat, lon, lat0, lon0)

    def one(s: Column) -> Column:
        ax, ay = planar_feet(s["a"]["latitude"], s["a"]["longitude"], lat0, lon0)
        bx, by = planar_feet(s["b"]["latitude"], s["b"]["longitude"], lat0, lon0)
        return segment_distance(px, py, ax, ay, bx, by)

    ax, ay = planar_feet(points[0]["latitude"], points[0]["longitude"], lat0, lon0)
    single = F.sqrt(F.pow(px - ax, 2) + F.pow(py - ay, 2))
    return F.when(F.size(points) == 0, F.lit(float("inf"))).when(F.size(points) == 1, single).otherwise(F.array_min(F.transform(_pairs(points), one)))


def point_in_ring(ring: Column, lat: Column, lon: Column) -> Column:
    """Even-odd rule; a ring of fewer than three points holds nothing."""

    def crosses(s: Column) -> Column:
        y1, x1, y2, x2 = s["a"]["latitude"], s["a"]["longitude"], s["b"]["latitude"], s["b"]["longitude"]
        over = (y1 > lat) != (y2 > lat)
        return F.when(over, lon < (x2 - x1) * (lat - y1) / F.when(over, y2 - y1).otherwise(F.lit(1.0)) + x1).otherwise(F.lit(False))

    return F.when(F.size(ring) < 3, F.lit(False)).otherwise(F.aggregate(F.transform(_pairs(closed(ring)), crosses), F.lit(False), lambda acc, c: acc != c))


def point_in_polygon(rings: Column, lat: Column, lon: Column) -> Column:
    """Inside the first ring and inside none of the others."""
    holes = F.when(F.size(rings) > 1, F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(1)))).otherwise(F.slice(rings, 1, 0))
    return F.when(F.size(rings) == 0, F.lit(False)).otherwise(point_in_ring(rings[0], lat, lon) & ~F.exists(holes, lambda h: point_in_ring(h, lat, lon)))


def polygon_distance(rings: Column, lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Feet to a polygon: 0 inside, else to the nearest edge of any ring."""
    edges = F.array_min(F.transform(rings, lambda r: line_distance(F.when(F.size(r) > 2, closed(r)).otherwise(r), lat, lon, lat0, lon0)))
    return F.when(point_in_polygon(rings, lat, lon), F.lit(0.0)).otherwise(F.coalesce(edges, F.lit(float("inf"))))


def feature_distance(kind: Column, points: Column, lines: Column, polygons: Column, lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Feet from a position to a feature by its kind (point, linestring, polygon): to the nearest of its parts; infinite for an
    unknown kind or a feature without parts of its kind."""
    px, py = planar_feet(lat, lon, lat0, lon0)

    def to_point(c: Column) -> Column:
        x, y = planar_feet(c["latitude"], c["longitude"], lat0, lon0)
        return F.sqrt(F.pow(px - x, 2) + F.pow(py - y, 2))

    nearest = (
        F.when(kind == "point", F.array_min(F.transform(points, to_point)))
        .when(kind == "linestring", F.array_min(F.transform(lines, lambda x: line_distance(x, lat, lon, lat0, lon0))))
        .when(kind == "polygon", F.array_min(F.transform(polygons, lambda p: polygon_distance(p, lat, lon, lat0, lon0))))
    )
    return F.coalesce(nearest, F.lit(float("inf")))


def ring_center(ring: Column) -> Column:
    """Mean of a ring's vertices, a closing one counted once; null for an empty ring."""
    own = F.when((F.size(ring) > 1) & (ring[0] == F.element_at(ring, -1)), F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(1)))).otherwise(ring)
    mean = lambda k: F.aggregate(own, F.lit(0.0), lambda a, c: a + c[k]) / F.size(own)
    return F.when(F.size(ring) > 0, coord(mean("latitude"), mean("longitude")))


def line_length(points: Column, radius: float = EARTH_RADIUS_FEET) -> Column:
    """Great-circle length of a line, in the unit of the radius."""
    return F.aggregate(_pairs(points), F.lit(0.0), lambda acc, s: acc + haversine(s["a"]["latitude"], s["a"]["longitude"], s["b"]["latitude"], s["b"]["longitude"], radius))


def perimeter(rings: Column) -> Column:
    """Length of all rings as they are given, holes as well."""
    return F.aggregate(F.transform(rings, lambda r: line_length(r)), F.lit(0.0), lambda acc, x: acc + x)


def ring_area(ring: Column) -> Column:
    """Square feet by the shoelace rule in a frame at the mean latitude of the ring's points; 0 for fewer than three points."""
    mean = F.aggregate(ring, F.lit(0.0), lambda acc, c: acc + c["latitude"]) / F.size(ring)
    fx = F.lit(FEET_PER_DEGREE) * F.cos(F.radians(mean))
    base = ring[0]

    def cross(s: Column) -> Column:
        ax, ay = (s["a"]["longitude"] - base["longitude"]) * fx, (s["a"]["latitude"] - base["latitude"]) * FEET_PER_DEGREE
        bx, by = (s["b"]["longitude"] - base["longitude"]) * fx, (s["b"]["latitude"] - base["latitude"]) * FEET_PER_DEGREE
        return ax * by - bx * ay

    return F.when(F.size(ring) < 3, F.lit(0.0)).otherwise(F.abs(F.aggregate(F.transform(_pairs(closed(ring)), cross), F.lit(0.0), lambda acc, x: acc + x)) / 2)


def polygon_area(rings: Column, subtract_holes: bool = False) -> Column:
    """Square feet of all rings; further rings count as area unless they are to be subtracted."""
    if not subtract_holes:
        return F.aggregate(F.transform(rings, lambda r: ring_area(r)), F.lit(0.0), lambda acc, x: acc + x)
    return F.aggregate(F.transform(rings, lambda r: ring_area(r)), F.lit(0.0), lambda acc, x: acc - x) + 2 * ring_area(rings[0])


def rectangle_sides(area: Column, around: Column) -> tuple[Column, Column]:
    """(length, width) of the rectangle of an area and perimeter; the nearest real one if there is none."""
    root = F.sqrt(F.greatest(F.lit(0.0), around * around - 16 * area))
    return (around + root) / 4, (around - root) / 4


def densify(points: Column, spacing: Column | float, radius: float = EARTH_RADIUS_FEET) -> Column:
    """The line with points added between neighbours, floor(distance / spacing) - 1 of them at multiples of the spacing."""
    spacing = F.lit(float(spacing)) if not isinstance(spacing, Column) else spacing

    def fill(s: Column) -> Column:
        a, b = s["a"], s["b"]
        d = haversine(a["latitude"], a["longitude"], b["latitude"], b["longitude"], radius)
        extra = F.greatest(F.lit(0), F.floor(d / spacing).cast("int") - 1)
        between = F.when(extra > 0, F.transform(F.sequence(F.lit(1), F.greatest(extra, F.lit(1))), lambda i: coord(a["latitude"] + (b["latitude"] - a["latitude"]) * (i * spacing / d), a["longitude"] + (b["longitude"] - a["longitude"]) * (i * spacing / d))))
        return F.concat(F.array(a), F.coalesce(between, F.array().cast("array<struct<latitude:double,longitude:double>>")))

    return F.when(F.size(points) < 2, points).otherwise(F.concat(F.flatten(F.transform(_pairs(points), fill)), F.slice(points, -1, 1)))


def distinct_points(points: Column, digits: int = 7) -> Column:
    """The first of the points that are equal when rounded half-even to some digits."""
    keys = F.transform(points, lambda c: F.struct(F.bround(c["latitude"], digits), F.bround(c["longitude"], digits)))
    return F.filter(points, lambda c, i: F.array_position(keys, F.struct(F.bround(c["latitude"], digits), F.bround(c["longitude"], digits))) == i + 1)


def representative(points: Column, lines: Column, polygons: Column) -> Column:
    """First point, else first vertex of a line, else of an outer ring."""
    return F.coalesce(F.get(points, F.lit(0)), F.get(F.get(lines, F.lit(0)), F.lit(0)), F.get(F.get(F.get(polygons, F.lit(0)), F.lit(0)), F.lit(0)))
