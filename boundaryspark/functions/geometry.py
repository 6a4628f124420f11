"""Geometry as column expressions on nested arrays (polygons > rings > points)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from boundaryspark.functions.scalars import col

# WGS 84 ellipsoid, authalic sphere of the map viewer, EPSG:6933 standard parallel.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SPHERE_RADIUS = 6371008.8
STANDARD_PARALLEL = 30.0

ECC2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(ECC2)
K0 = math.cos(math.radians(STANDARD_PARALLEL)) / math.sqrt(
    1 - ECC2 * math.sin(math.radians(STANDARD_PARALLEL)) ** 2)

TOLERANCE = 1e-5


def map_points(geom: Column | str, change) -> Column:
    """Apply `change(point) -> struct(x, y)` to each vertex."""
    return F.transform(col(geom), lambda p: F.transform(p, lambda r: F.transform(r, change)))


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def equidistant_x(lon: Column) -> Column:
    return F.radians(lon) * SEMI_MAJOR


def equidistant_y(lat: Column) -> Column:
    return F.radians(lat) * SEMI_MAJOR


def equal_area_x(lon: Column) -> Column:
    return F.radians(lon) * (SEMI_MAJOR * K0)


def equal_area_y(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    q = (1 - ECC2) * (s / (1 - ECC2 * s * s) - F.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))
    return q * (SEMI_MAJOR / (2 * K0))


def project_equidistant(geom: Column | str) -> Column:
    return map_points(geom, lambda v: xy(equidistant_x(v["x"]), equidistant_y(v["y"])))


def project_equal_area(geom: Column | str) -> Column:
    return map_points(geom, lambda v: xy(equal_area_x(v["x"]), equal_area_y(v["y"])))


def ring_steps(ring: Column) -> Column:
    """Consecutive vertex pairs of a ring as struct(a, b)."""
    n = F.size(ring)
    return F.zip_with(F.slice(ring, 1, F.greatest(n - 1, F.lit(0))), F.slice(ring, 2, F.greatest(n - 1, F.lit(0))),
                      lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def sum_steps(ring: Column, value) -> Column:
    return F.aggregate(ring_steps(ring), F.lit(0.0), lambda acc, s: acc + value(s["a"], s["b"]))


def edge_cross(x1, y1, x2, y2, x0, y0) -> Column:
    """Twice the signed area an edge adds, taken around a near origin to keep digits."""
    return (x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)


def ring_area(ring: Column | str) -> Column:
    """Signed planar area, positive for counter-clockwise rings."""
    r = col(ring)
    o = F.element_at(r, 1)
    return sum_steps(r, lambda a, b: edge_cross(a["x"], a["y"], b["x"], b["y"], o["x"], o["y"])) / 2


def ring_length(ring: Column | str) -> Column:
    return sum_steps(col(ring), lambda a, b: planar_length(a["x"], a["y"], b["x"], b["y"]))


def planar_length(x1, y1, x2, y2) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def spherical_area_term(lon1, lat1, lon2, lat2) -> Column:
    """Share of an edge in the spherical ring area; the ring sums are positive for clockwise rings."""
    return F.radians(lon2 - lon1) * (2 + F.sin(F.radians(lat1)) + F.sin(F.radians(lat2))) \
        * (SPHERE_RADIUS * SPHERE_RADIUS / 2)


def great_circle(lon1, lat1, lon2, lat2) -> Column:
    dlat = F.sin(F.radians(lat2 - lat1) / 2)
    dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = dlat * dlat + dlon * dlon * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return 2 * SPHERE_RADIUS * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def ring_area_spherical(ring: Column | str) -> Column:
    return F.abs(sum_steps(col(ring), lambda a, b: spherical_area_term(a["x"], a["y"], b["x"], b["y"])))


def ring_length_spherical(ring: Column | str) -> Column:
    return sum_steps(col(ring), lambda a, b: great_circle(a["x"], a["y"], b["x"], b["y"]))


def _sum_rings(geom: Column | str, value) -> Column:
    per_polygon = F.transform(col(geom), lambda p: F.aggregate(
        F.transform(p, lambda r, i: value(r, i)), F.lit(0.0), lambda acc, v: acc + v))
    return F.aggregate(per_polygon, F.lit(0.0), lambda acc, v: acc + v)


def _signed(index: Column, size: Column) -> Column:
    return F.when(index == 0, size).otherwise(-size)


def planar_area(geom: Column | str) -> Column:
    """Shells minus holes, whatever their direction."""
    return _sum_rings(geom, lambda r, i: _signed(i, F.abs(ring_area(r))))


def planar_perimeter(geom: Column | str) -> Column:
    return _sum_rings(geom, lambda r, i: ring_length(r))


def spherical_area(geom: Column | str) -> Column:
    return _sum_rings(geom, lambda r, i: _signed(i, ring_area_spherical(r)))


def spherical_perimeter(geom: Column | str) -> Column:
    return _sum_rings(geom, lambda r, i: ring_length_spherical(r))


def shell_vertices(geom: Column | str) -> Column:
    """Vertices of shells, closing vertex included."""
    return F.aggregate(F.transform(col(geom), lambda p: F.size(F.element_at(p, 1)).cast("long")),
                       F.lit(0).cast("long"), lambda acc, n: acc + n)


def all_vertices(geom: Column | str) -> Column:
    return F.aggregate(F.flatten(F.transform(col(geom), lambda p: F.transform(p, lambda r: F.size(r).cast("long")))),
                       F.lit(0).cast("long"), lambda acc, n: acc + n)


def bounds(geom: Column | str) -> dict[str, Column]:
    points = F.flatten(F.flatten(col(geom)))
    xs, ys = F.transform(points, lambda v: v["x"]), F.transform(points, lambda v: v["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def within_earth(xmin, ymin, xmax, ymax, tolerance: float = TOLERANCE) -> Column:
    return ((col(xmin) >= -180 - tolerance) & (col(xmax) <= 180 + tolerance)
            & (col(ymin) >= -90 - tolerance) & (col(ymax) <= 90 + tolerance))


def as_multipolygon(polygon: Column | str) -> Column:
    return F.array(col(polygon))


def _same(a: Column, b: Column) -> Column:
    return (a["x"] == b["x"]) & (a["y"] == b["y"])


def _named(value: Column, use) -> Column:
    """`use(value)` with the value worked out once, however often and inside whatever loops `use` names it."""
    return F.transform(F.array(value), use)[0]


def clean_ring(ring: Column | str, is_shell: Column) -> Column:
    """Close the ring, drop repeated vertices, orient shells counter-clockwise and holes clockwise.

    The vertex list is walked by index and each step's list is worked out once, so the cost stays linear in its length.
    """
    def closed(r):
        return F.when((F.size(r) > 0) & ~_same(F.element_at(r, 1), F.element_at(r, -1)), F.concat(r, F.slice(r, 1, 1))).otherwise(r)

    def distinct(c):
        before = F.concat(F.slice(c, 1, 1), F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))))
        marked = F.zip_with(c, before, lambda v, p: F.struct(v.alias("v"), p.alias("p")))
        return F.transform(F.filter(marked, lambda m, i: (i == 0) | ~_same(m["v"], m["p"])), lambda m: m["v"])

    def turned(d):
        return F.when((ring_area(d) >= 0) == is_shell, d).otherwise(F.reverse(d))

    return _named(col(ring), lambda r: _named(closed(r), lambda c: _named(distinct(c), turned)))


def clean_rings(geom: Column | str) -> Column:
    """Cleaned polygons; rings with fewer than four points and polygons without shell disappear."""
    cleaned = F.transform(col(geom), lambda p: F.transform(p, lambda r, i: clean_ring(r, i == 0)))
    with_shell = F.filter(cleaned, lambda p: F.size(F.element_at(p, 1)) >= 4)
    return F.transform(with_shell, lambda p: F.filter(p, lambda r: F.size(r) >= 4))


def snap_value(value: Column, grid: float = TOLERANCE) -> Column:
    return F.round(value / grid) * grid


def snap_vertices(geom: Column | str, grid: float = TOLERANCE) -> Column:
    """Vertices rounded to a grid, then cleaned."""
    return clean_rings(map_points(geom, lambda v: xy(snap_value(v["x"], grid), snap_value(v["y"], grid))))


def number_text(value: Column) -> Column:
    """Fixed rendering of a coordinate with nine decimals."""
    return F.format_string("%.9f", value)


def geometry_text(geom: Column | str) -> Column:
    """Canonical text of a geometry; identifiers are hashes of it."""
    def ring(r):
        return F.concat(F.lit("("), F.array_join(F.transform(
            r, lambda v: F.concat(number_text(v["x"]), F.lit(" "), number_text(v["y"]))), ","), F.lit(")"))

    def polygon(p):
        return F.concat(F.lit("("), F.array_join(F.transform(p, ring), ","), F.lit(")"))

    return F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(col(geom), polygon), ","), F.lit(")"))
