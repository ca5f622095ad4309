"""Planar geometry as plain column expressions.

Spark ships no point constructor, containment or grid function, so points
are ``struct<lon,lat>`` columns and regions are edge arrays built once on the
(small) region side.  Everything here stays inside Catalyst:
no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.functions.common import idiv

# Fixed value: spatial reference of every geometry (WGS 84 lon/lat); geometry columns name it in their metadata.
SRID = 4326
SRID_METADATA = {"srid": SRID}


def srid_of(df: DataFrame, column: str) -> int | None:
    """``ST_SRID``: the spatial reference that a geometry column names."""
    return df.schema[column].metadata.get("srid")


def make_point(lon: Column, lat: Column) -> Column:
    """``ST_SetSRID(ST_MakePoint(lon, lat), 4326)``; NULL when either is NULL."""
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat")))


def snap_index(coord: Column, size: float) -> Column:
    """Grid index of ``ST_SnapToGrid(geom, size)``: ``rint(coord / size)``.

    ``rint`` rounds half to even, as the snapping does.
    """
    return F.rint(coord / F.lit(size)).cast("long")


def _decimal_text(index: Column, size_tenths: int) -> Column:
    """``index * size`` as the shortest decimal text (``11`` → ``1.1``, ``10`` → ``1``).

    Built from integers so it never depends on how an engine prints doubles.
    Only grid sizes that are whole tenths are supported.
    """
    tenths = index * F.lit(size_tenths)
    mag = F.abs(tenths)
    frac = F.pmod(mag, F.lit(10))
    return F.concat(
        F.when(tenths < 0, F.lit("-")).otherwise(F.lit("")),
        idiv(mag, 10).cast("string"),
        F.when(frac != 0, F.concat(F.lit("."), frac.cast("string"))).otherwise(F.lit("")),
    )


def grid_cell_text(gx: Column, gy: Column, size: float) -> Column:
    """``ST_AsText(ST_SnapToGrid(geom, size))`` → ``POINT(x y)``."""
    size_tenths = round(size * 10)
    if abs(size_tenths - size * 10) > 1e-9 or size_tenths <= 0:
        raise ValueError("grid text supports sizes that are whole tenths of a degree")
    return F.when(gx.isNotNull() & gy.isNotNull(), F.concat(
        F.lit("POINT("), _decimal_text(gx, size_tenths), F.lit(" "), _decimal_text(gy, size_tenths), F.lit(")")))


# --------------------------------------------------------------------------
# GeoJSON

_POSITION = "array<double>"
_LINE = f"array<{_POSITION}>"
_POLYGON = f"array<{_LINE}>"
_MULTI = f"array<{_POLYGON}>"
# fixed values: the types of a GeoJSON geometry with coordinates
GEOMETRY_TYPES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")
# collections within collections that are opened
MAX_NESTING = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def geometries(geojson: Column) -> Column:
    """GeoJSON text → the variants of its geometries; features and collections opened, NULL for text that is no JSON."""
    def kind(g: Column) -> Column:
        return F.try_variant_get(g, "$.type", "string")

    def opened(g: Column) -> Column:
        return (F.when(kind(g) == "Feature", F.array(F.try_variant_get(g, "$.geometry", "variant")))
                .when(kind(g) == "FeatureCollection", F.try_variant_get(g, "$.features", "array<variant>"))
                .when(kind(g) == "GeometryCollection", F.try_variant_get(g, "$.geometries", "array<variant>"))
                .otherwise(F.array(g)))

    found = F.transform(F.array(geojson), lambda text: F.try_parse_json(text))
    found = F.when(found[0].isNotNull(), found)
    for _ in range(MAX_NESTING):
        found = F.flatten(F.transform(found, lambda g: F.coalesce(opened(g), F.array(g))))
    return found


def shapes(found: Column) -> Column:
    """Geometries → ``struct<polygons, lines, dots, bad>``: coordinates by dimension, and how many geometries have none to read."""
    def read(g: Column, single: str, several: str, shape: str) -> Column:
        kind = F.try_variant_get(g, "$.type", "string")
        return (F.when(kind == single, F.transform(F.array(F.try_variant_get(g, "$.coordinates", shape)), lambda c: c))
                .when(kind == several, F.try_variant_get(g, "$.coordinates", f"array<{shape}>"))
                .otherwise(F.array().cast(f"array<{shape}>")))

    def every(single: str, several: str, shape: str) -> Column:
        return F.flatten(F.transform(found, lambda g: F.coalesce(read(g, single, several, shape), F.array(F.lit(None).cast(shape)))))

    bad = F.size(F.filter(found, lambda g: ~F.coalesce(F.try_variant_get(g, "$.type", "string").isin(*GEOMETRY_TYPES), F.lit(False))))
    return F.struct(every("Polygon", "MultiPolygon", _POLYGON).alias("polygons"), every("LineString", "MultiLineString", _LINE).alias("lines"),
                    every("Point", "MultiPoint", _POSITION).alias("dots"), bad.alias("bad"))


def _distinct(line: Column) -> Column:
    return F.size(F.array_distinct(F.transform(line, lambda p: F.struct(p[0], p[1]))))


def invalid_reasons(shape: Column) -> Column:
    """Why a region's geometry cannot be used, in order; empty if it can.  A NULL shape is text that is no JSON."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def position(p: Column) -> Column:
        return F.coalesce((F.size(p) >= 2) & finite(F.get(p, 0)) & finite(F.get(p, 1)), F.lit(False))

    def positions(line: Column) -> Column:
        return F.coalesce(F.forall(line, position), F.lit(False))

    all_lines = F.concat(shape["lines"], F.flatten(F.filter(shape["polygons"], lambda p: p.isNotNull())))
    sound = (F.forall(shape["dots"], position) & F.forall(all_lines, positions) & F.forall(shape["polygons"], lambda p: p.isNotNull()))
    rings = F.flatten(shape["polygons"])
    return F.when(shape.isNull(), F.array(F.lit("json invalide"))).otherwise(F.filter(F.array(
        F.when(shape["bad"] > 0, "type inconnu"),
        F.when(~F.coalesce(sound, F.lit(False)), "coordonnées invalides"),
        F.when(F.coalesce(sound, F.lit(False)) & F.exists(rings, lambda r: (_distinct(r) < 3) | ~_spread(r)), "contour sans surface"),
        F.when(F.coalesce(sound, F.lit(False)) & F.exists(shape["lines"], lambda r: _distinct(r) < 2), "ligne sans longueur"),
    ), lambda r: r.isNotNull()))


def _spread(ring: Column) -> Column:
    """Whether a ring's positions do not all lie on the line through its first position and the one farthest along it."""
    first = ring[0]
    # any position apart from the first one gives the line
    return let(F.get(F.filter(ring, lambda p: (p[0] != first[0]) | (p[1] != first[1])), 0), lambda other: F.coalesce(
        F.exists(ring, lambda p: orientation(first[0], first[1], other[0], other[1], p[0], p[1]) != 0), F.lit(False)))


# --------------------------------------------------------------------------
# robust orientation

# half a unit in the last place of 1, and Shewchuk's bound of the plain determinant's error
_EPS = 2.0 ** -53
_ORIENT_BOUND = (3 + 16 * _EPS) * _EPS
_SPLITTER = 2.0 ** 27 + 1


def _tail_of_difference(a: Column, b: Column) -> Column:
    """(a - b) exactly = the rounded difference + this."""
    d = a - b
    v = a - d
    return (a - (d + v)) + (v - b)


def _product(u: Column, v: Column) -> Column:
    """u * v exactly, as the rounded product and the rest."""
    def high(x: Column) -> Column:
        c = x * F.lit(_SPLITTER)
        return c - (c - x)

    def rest(p: Column) -> Column:
        ul, vl = p["u"] - p["uh"], p["v"] - p["vh"]
        x = p["u"] * p["v"]
        return F.array(ul * vl - (((x - p["uh"] * p["vh"]) - ul * p["vh"]) - p["uh"] * vl), x)

    return let(F.struct(u.alias("u"), v.alias("v"), high(u).alias("uh"), high(v).alias("vh")), rest)


def _exact_sign(terms: Column) -> Column:
    """The sign of an exact sum of doubles: the terms are added to an expansion, whose last non-zero part has it."""
    def add(parts: Column, b: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            s = acc["q"] + x
            v = s - acc["q"]
            return F.struct(s.alias("q"), F.concat(acc["h"], F.array((acc["q"] - (s - v)) + (x - v))).alias("h"))

        return F.aggregate(parts, F.struct(b.alias("q"), F.array().cast("array<double>").alias("h")), step,
                           lambda acc: F.concat(acc["h"], F.array(acc["q"])))

    total = F.aggregate(terms, F.array().cast("array<double>"), add)
    return F.aggregate(total, F.lit(0.0), lambda acc, x: F.when(x != 0, F.signum(x)).otherwise(acc))


def orientation(x1: Column, y1: Column, x2: Column, y2: Column, px: Column, py: Column) -> Column:
    """Which side of the line from 1 to 2 the point lies on: 1.0 left, -1.0 right, 0.0 on the line.  Never wrong.

    The plain determinant decides wherever it exceeds the bound of its own
    error.  Elsewhere its differences and products are expanded without
    rounding and the sign of the exact sum is taken.  (Exact unless products
    underflow: for differences of more than 1e-140.)
    """
    def product(a, b, c, d, sign: float) -> Column:
        """The exact terms of sign * (a - b) * (c - d)."""
        left = F.array((a - b) * F.lit(sign), _tail_of_difference(a, b) * F.lit(sign))
        right = F.array(c - d, _tail_of_difference(c, d))
        return F.flatten(F.flatten(F.transform(left, lambda u: F.transform(right, lambda v: _product(u, v)))))

    left, right = (x2 - x1) * (py - y1), (y2 - y1) * (px - x1)
    det = left - right
    flat = ((x2 == x1) | (py == y1)) & ((y2 == y1) | (px == x1))
    exact = _exact_sign(F.concat(product(x2, x1, py, y1, 1.0), product(y2, y1, px, x1, -1.0)))
    return (F.when(F.abs(det) > F.lit(_ORIENT_BOUND) * (F.abs(left) + F.abs(right)), F.signum(det))
            .when(flat, F.lit(0.0)).otherwise(exact))


# --------------------------------------------------------------------------
# regions

def line_edges(line: Column, closed: bool = False) -> Column:
    """Positions → ``array<struct<x1,y1,x2,y2>>`` of their edges; ``closed`` adds the one from the last to the first."""
    n = F.size(line)
    steps = F.sequence(F.lit(0), n - (1 if closed else 2))

    def edge(i: Column) -> Column:
        p, q = line[i], F.element_at(line, F.pmod(i + 1, n) + 1)
        return F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2"))

    return F.filter(F.transform(F.when(n >= 2, steps).otherwise(F.array().cast("array<int>")), edge),
                    lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def _points(positions: Column) -> Column:
    return F.transform(positions, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def region_columns(shape: Column) -> list[Column]:
    """``parts`` (the edges of each polygon, all its rings), ``lines`` (edges), ``ends`` (points that end an odd number of
    lines, the boundary of lines), ``dots`` and ``bbox`` of a region's shape."""
    parts = F.transform(shape["polygons"], lambda p: F.flatten(F.transform(p, lambda r: line_edges(r, True))))
    lines = F.flatten(F.transform(shape["lines"], lambda r: line_edges(r)))
    tips = F.flatten(F.transform(F.filter(shape["lines"], lambda r: F.size(r) > 0), lambda r: _points(F.array(r[0], F.element_at(r, -1)))))
    ends = F.filter(F.array_distinct(tips), lambda p: F.size(F.filter(tips, lambda q: q == p)) % 2 == 1)
    every = F.concat(F.flatten(F.flatten(shape["polygons"])), F.flatten(shape["lines"]), shape["dots"])
    xs, ys = F.transform(every, lambda p: p[0]), F.transform(every, lambda p: p[1])
    box = F.struct(F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    return [parts.alias("parts"), lines.alias("lines"), ends.alias("ends"), _points(shape["dots"]).alias("dots"),
            F.when(F.size(every) > 0, box).alias("bbox")]


def outline(region: Callable[[str], Column]) -> Column:
    """All edges of a region, with its dots as edges without length: what a grid cell may touch."""
    return F.concat(F.flatten(region("parts")), region("lines"), F.transform(region("dots"), lambda p: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2"))))


def on_edge(e: Column, px: Column, py: Column) -> Column:
    return ((px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"]))
            & (orientation(e["x1"], e["y1"], e["x2"], e["y2"], px, py) == 0))


def _code(e: Column, px: Column, py: Column) -> Column:
    """2: the point lies on the edge; 1: a ray from it towards +x crosses the edge; 0: neither."""
    up, down = (e["y1"] <= py) & (e["y2"] > py), (e["y2"] <= py) & (e["y1"] > py)
    side = orientation(e["x1"], e["y1"], e["x2"], e["y2"], px, py)
    near = (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])) & (px <= F.greatest(e["x1"], e["x2"]))
    # an edge wholly to the right needs no side
    return (F.when(~near, F.lit(0)).when(px < F.least(e["x1"], e["x2"]), (up | down).cast("int"))
            .otherwise(let(side, lambda s: F.when(s == 0, F.lit(2)).when((up & (s > 0)) | (down & (s < 0)), F.lit(1)).otherwise(F.lit(0)))))


def in_part(edges: Column, px: Column, py: Column) -> Column:
    """Strictly inside one polygon: even-odd over its rings, so holes need no special case; its boundary is out."""
    return let(F.transform(edges, lambda e: _code(e, px, py)), lambda codes: ~F.exists(codes, lambda c: c == 2) & (
        F.size(F.filter(codes, lambda c: c == 1)) % 2 == 1))


def within(px: Column, py: Column, region: Callable[[str], Column]) -> Column:
    """``ST_Within(point, geometry)``: in the interior of any of the region's parts, lines or points; the boundary is out.

    Parts that overlap are one area.  ``region`` gives the region's columns by
    name.  A NULL point is never within.
    """
    line = F.exists(region("lines"), lambda e: on_edge(e, px, py)) & ~F.exists(region("ends"), lambda p: (p["x"] == px) & (p["y"] == py))
    dot = F.exists(region("dots"), lambda p: (p["x"] == px) & (p["y"] == py))
    inside = F.exists(region("parts"), lambda edges: in_part(edges, px, py)) | line | dot
    return F.coalesce(px.isNotNull() & py.isNotNull() & inside, F.lit(False))


def in_bbox(px: Column, py: Column, bbox: Column) -> Column:
    return ((px >= bbox["x0"]) & (px <= bbox["x1"]) & (py >= bbox["y0"]) & (py <= bbox["y1"]))
