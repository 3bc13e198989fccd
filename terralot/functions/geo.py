"""Geometry as nested arrays: polygons are ARRAY of polygons, of rings, of (x, y) structs. No UDFs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def _edges(ring: Column, test) -> Column:
    """`test(point, the point before)` of each edge; the first point's predecessor is the last."""
    return F.transform(ring, lambda p, i: test(p, F.element_at(ring, F.when(i == 0, F.size(ring)).otherwise(i))))


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule over half-open edges."""

    def crosses(p: Column, q: Column) -> Column:
        spans = (p["y"] > y) != (q["y"] > y)
        return F.when(spans, x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]).otherwise(F.lit(False))

    return F.aggregate(_edges(ring, crosses), F.lit(False), lambda a, b: a != b)


def point_in_polygons(x: Column, y: Column, polygons: Column) -> Column:
    """In the outer ring and in none of the holes of any one polygon."""
    return F.exists(
        polygons, lambda rings: point_in_ring(x, y, rings[0]) & ~F.exists(F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0))), lambda hole: point_in_ring(x, y, hole))
    )


def on_boundary(x: Column, y: Column, polygons: Column) -> Column:
    def on(p: Column, q: Column) -> Column:
        cross = (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])
        return (cross == 0) & x.between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & y.between(F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"]))

    return F.exists(polygons, lambda rings: F.exists(rings, lambda ring: F.exists(_edges(ring, on), lambda b: b)))


def within(x: Column, y: Column, polygons: Column) -> Column:
    """Strictly inside: points of the boundary are outside."""
    return point_in_polygons(x, y, polygons) & ~on_boundary(x, y, polygons)


def ring_centroid(ring: Column) -> Column:
    """struct(area, x, y) of a closed ring: signed area and centre of area; the mean of the points if it has no area."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(s: Column, i: Column) -> Column:
        p, q = F.element_at(ring, i), F.element_at(ring, i + 1)
        cross = p["x"] * q["y"] - q["x"] * p["y"]
        return F.struct((s["a"] + cross).alias("a"), (s["x"] + (p["x"] + q["x"]) * cross).alias("x"), (s["y"] + (p["y"] + q["y"]) * cross).alias("y"))

    def end(s: Column) -> Column:
        mean = lambda k: F.aggregate(ring, F.lit(0.0), lambda a, p: a + p[k]) / F.size(ring)
        flat = F.abs(s["a"]) < 1e-14
        return F.struct(
            F.when(flat, F.lit(0.0)).otherwise(s["a"] / 2).alias("area"), F.when(flat, mean("x")).otherwise(s["x"] / (3 * s["a"])).alias("x"), F.when(flat, mean("y")).otherwise(s["y"] / (3 * s["a"])).alias("y")
        )

    steps = F.when(F.size(ring) > 1, F.sequence(F.lit(1), F.size(ring) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, zero, add, end)


def feature_centroid(polygons: Column) -> Column:
    """Centre of the largest outer ring (the first of equal ones), 5 decimals, halves to even."""
    each = F.transform(polygons, lambda rings: ring_centroid(rings[0]))
    best = F.aggregate(
        each, F.element_at(each, 1), lambda a, b: F.when(F.abs(b["area"]) > F.abs(a["area"]), b).otherwise(a), lambda s: F.struct(F.bround(s["x"], 5).alias("cx"), F.bround(s["y"], 5).alias("cy"))
    )
    return F.when(F.size(polygons) > 0, best)


def bbox(polygons: Column, digits: int | None = None) -> Column:
    """struct(xmin, ymin, xmax, ymax)."""
    points = F.flatten(F.flatten(polygons))
    take = lambda f, k: f(F.transform(points, lambda p: p[k]))
    near = (lambda c: c) if digits is None else (lambda c: F.bround(c, digits))
    return F.struct(
        near(take(F.array_min, "x")).alias("xmin"), near(take(F.array_min, "y")).alias("ymin"), near(take(F.array_max, "x")).alias("xmax"), near(take(F.array_max, "y")).alias("ymax")
    )


def interior_point(polygons: Column) -> Column:
    """A point strictly inside: on scan lines through the box, the middle of the widest inner span.

    On a line y = c the edges' crossings, sorted, bound the spans inside (even-odd over all rings); of
    several lines at uneven heights the widest span counts.
    """
    box = bbox(polygons)
    rings = F.flatten(polygons)
    best = None
    for share in (0.5, 0.37, 0.61, 0.23, 0.79, 0.11, 0.91):
        y = box["ymin"] + (box["ymax"] - box["ymin"]) * F.lit(share)

        def crossing(p: Column, q: Column, y=y) -> Column:
            return F.when((p["y"] > y) != (q["y"] > y), (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"])

        xs = F.array_sort(F.filter(F.flatten(F.transform(rings, lambda r: _edges(r, crossing))), lambda v: v.isNotNull()))
        spans = F.transform(
            F.filter(F.transform(xs, lambda v, i: F.struct((F.get(xs, i + 1) - v).alias("w"), ((F.get(xs, i + 1) + v) / 2).alias("x"), (i % 2).alias("odd"))), lambda s: (s["odd"] == 0) & s["w"].isNotNull()),
            lambda s: F.struct(s["w"].alias("w"), s["x"].alias("x"), y.alias("y")),
        )
        best = spans if best is None else F.concat(best, spans)
    top = F.array_max(best)
    return F.struct(top["x"].alias("x"), top["y"].alias("y"))


def vertex_counts(polygons: Column) -> Column:
    """struct(rings, vertices); a ring's closing point doesn't count."""
    rings = F.flatten(polygons)
    return F.struct(F.size(rings).alias("rings"), F.aggregate(rings, F.lit(0), lambda a, r: a + F.size(r) - 1).alias("vertices"))


def signed_area(ring: Column) -> Column:
    """Twice the ring's signed area in tile space (y downwards: above 0 for an outer ring)."""
    edge = _edges(ring, lambda p, q: q["x"] * p["y"] - p["x"] * q["y"])
    return F.aggregate(edge, F.lit(0.0), lambda a, b: a + b)


def exterior_rings(rings: Column) -> Column:
    return F.filter(rings, lambda r: signed_area(r) > 0)


def tile_x(lon: Column, z: int) -> Column:
    return F.floor((lon + F.lit(180.0)) / F.lit(360.0) * F.lit(float(2**z))).cast("int")


def tile_y(lat: Column, z: int) -> Column:
    r = F.radians(lat)
    return F.floor((F.lit(1.0) - F.log(F.tan(r) + F.lit(1.0) / F.cos(r)) / F.lit(math.pi)) / F.lit(2.0) * F.lit(float(2**z))).cast("int")


def tile_point_to_wgs84(z: Column, x: Column, y: Column, px: Column, py: Column, extent: Column | int = 4096) -> Column:
    """struct(lon, lat) of a point in a tile."""
    n, size = F.pow(F.lit(2.0), z), (extent if isinstance(extent, Column) else F.lit(extent)).cast("double")
    lon = (x + px / size) / n * 360 - 180
    lat = F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * (y + py / size) / n))))
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def tiles_of_bbox(lon0: float, lat0: float, lon1: float, lat1: float, z: int) -> list[tuple[int, int]]:
    """(x, y) of the tiles that a view covers, by x and then y; the y axis runs southwards."""
    n = 2**z
    col = lambda lon: int(math.floor((lon + 180) / 360 * n))
    row = lambda lat: int(math.floor((1 - math.log(math.tan(math.radians(lat)) + 1 / math.cos(math.radians(lat))) / math.pi) / 2 * n))
    return [(x, y) for x in range(col(lon0), col(lon1) + 1) for y in range(row(lat1), row(lat0) + 1)]
