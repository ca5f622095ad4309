"""Point-in-polygon and the grid join against an independent brute force."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from civicflow.functions import geo
from civicflow.operators.spatial_join import region_table, rejected_regions, within_join
from civicflow.schemas import REGION_SOURCE


def _regions(spark, polys):
    rows = [(i + 1, f"r{i + 1}", json.dumps(g)) for i, g in enumerate(polys)]
    return region_table(spark.createDataFrame(rows, REGION_SOURCE))


def _poly(*rings):
    return {"type": "Polygon", "coordinates": [list(map(list, r)) for r in rings]}


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]
TRIANGLE = [(10, 0), (14, 0), (12, 3), (10, 0)]


def _inside_brute(px, py, rings):
    """Winding number over all rings (holes wind the other way in even-odd
    terms, so use crossing parity of the winding per ring), boundary excluded."""
    def on_seg(ax, ay, bx, by):
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        return cross == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by)

    parity = 0
    for ring in rings:
        n = len(ring)
        for i in range(n):
            (ax, ay), (bx, by) = ring[i], ring[(i + 1) % n]
            if (ax, ay) == (bx, by):
                continue
            if on_seg(ax, ay, bx, by):
                return False
        wn = 0
        for i in range(n):
            (ax, ay), (bx, by) = ring[i], ring[(i + 1) % n]
            if ay <= py < by and (bx - ax) * (py - ay) - (by - ay) * (px - ax) > 0:
                wn += 1
            elif by <= py < ay and (bx - ax) * (py - ay) - (by - ay) * (px - ax) < 0:
                wn -= 1
        parity ^= (wn != 0)
    return bool(parity)


def _pairs(df):
    return sorted((r["pid"], r["region_id"]) for r in df.select("pid", "region_id").collect())


def test_within_square_hole_triangle_and_edges(spark):
    regions = _regions(spark, [
        _poly(SQUARE, HOLE),
        _poly(TRIANGLE),
        {"type": "MultiPolygon", "coordinates": [[[[20, 0], [21, 0], [21, 1], [20, 1], [20, 0]]],
                                                 [[[22, 0], [23, 0], [23, 1], [22, 1], [22, 0]]]]},
    ])
    pts = [
        (1, 0.5, 0.5),   # in square, outside hole
        (2, 2.0, 2.0),   # in the hole
        (3, 0.0, 2.0),   # on the outer edge
        (4, 1.0, 2.0),   # on the hole edge
        (5, 4.0, 4.0),   # corner
        (6, 12.0, 1.0),  # in triangle
        (7, 12.0, 3.0),  # triangle apex
        (8, 20.5, 0.5),  # first part of the multipolygon
        (9, 22.5, 0.5),  # second part
        (10, 21.5, 0.5), # between the parts
        (11, None, 1.0), # no point
    ]
    points = spark.createDataFrame(pts, "pid int, lon double, lat double")
    got = _pairs(within_join(points, regions, cell=0.5))
    assert got == [(1, 1), (6, 2), (8, 3), (9, 3)]


@pytest.mark.parametrize("cell,max_cells,bcast", [(0.1, 16, 10**9), (0.5, 64, 10**9), (3.0, 4, 0),
                                                  (0.05, 256, 10**9), (1.0, 1, 0)])
def test_grid_join_equals_brute_force(spark, cell, max_cells, bcast):
    rng = random.Random(7)
    polys, shapes = [], []
    for k in range(12):
        cx, cy, r = rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(0.3, 4)
        n = rng.randint(3, 9)
        angles = sorted(rng.uniform(0, 6.283) for _ in range(n))
        import math
        ring = [(round(cx + r * rng.uniform(0.4, 1) * math.cos(a), 3), round(cy + r * rng.uniform(0.4, 1) * math.sin(a), 3))
                for a in angles]
        ring.append(ring[0])
        polys.append(_poly(ring))
        shapes.append([ring])
    pts = [(i, round(rng.uniform(-10, 10), 2), round(rng.uniform(-10, 10), 2)) for i in range(1500)]
    # some points exactly on vertices
    pts += [(2000 + k, s[0][0][0], s[0][0][1]) for k, s in enumerate(shapes)]
    points = spark.createDataFrame(pts, "pid int, lon double, lat double")
    got = _pairs(within_join(points, _regions(spark, polys), cell=cell, max_cells=max_cells,
                             broadcast_max_edges=bcast, broadcast_max_cells=bcast))
    want = sorted((pid, k + 1) for pid, x, y in pts for k, s in enumerate(shapes) if _inside_brute(x, y, s))
    assert got == want


def test_large_and_small_regions_use_several_levels(spark):
    from civicflow.operators.spatial_join import cell_stats, region_cells, region_geometry
    regions = _regions(spark, [_poly([(-50, -50), (50, -50), (50, 50), (-50, 50), (-50, -50)]),
                               _poly([(0, 0), (0.2, 0), (0.2, 0.2), (0, 0.2), (0, 0)])])
    stats = cell_stats(region_cells(regions, 0.25, 64), region_geometry(regions))
    assert len(stats.levels) == 2
    assert stats.cells <= 2 * 64
    kinds = {r["inside"] for r in region_cells(regions, 0.25, 64).collect()}
    assert kinds == {True, False}


@pytest.mark.parametrize("bcast", [10**9, 0])
def test_hot_cells_are_divided_and_lose_nothing(spark, bcast):
    """Most points crowd around one corner of a polygon, on both sides of its border, some on it; another region is quiet."""
    from civicflow.operators.spatial_join import hot_cells, refined, region_cells
    rng = random.Random(5)
    ring = [(0.3, 0.3), (6.1, 0.7), (5.2, 5.9), (0.9, 4.4), (0.3, 0.3)]
    polys = [_poly(ring), _poly([(-3, -3), (1, -3), (1, 1), (-3, 1), (-3, -3)]), _poly([(8, 8), (9, 8), (9, 9), (8, 8)])]
    pts = [(i, 0.3 + rng.gauss(0, 0.2), 0.3 + rng.gauss(0, 0.2)) for i in range(3000)]
    pts += [(3000 + i, rng.uniform(-4, 10), rng.uniform(-4, 10)) for i in range(500)]
    pts += [(4000, 0.3, 0.3), (4001, 1.0, 1.0), (4002, 1.0, 0.5), (4003, 0.6, 2.35), (4004, -0.0, 0.5)]
    points, regions = spark.createDataFrame(pts, "pid int, lon double, lat double"), _regions(spark, polys)
    cells = region_cells(regions, 1.0, 64)
    hot = hot_cells(points, cells, "lon", "lat", 1.0, 100, 1.0)
    fine = refined(cells, regions, hot, 1.0)
    assert hot.count() > 0 and fine.agg(F.min("level")).first()[0] < cells.agg(F.min("level")).first()[0]
    assert cells.where("inside").join(fine, cells.columns, "left_anti").count() == 0
    # a sample finds them too
    assert hot_cells(points, cells, "lon", "lat", 1.0, 100, 0.2).count() > 0
    options = dict(cell=1.0, broadcast_max_edges=bcast, broadcast_max_cells=bcast)
    got = _pairs(within_join(points, regions, hot_points=100, sample_rate=1.0, **options))
    assert got == _pairs(within_join(points, regions, **options))
    assert got == sorted((pid, k + 1) for pid, x, y in pts for k, g in enumerate(polys) if _inside_brute(x, y, [[tuple(p) for p in g["coordinates"][0]]]))
    # few points are left for the exact test
    def tested(c):
        from civicflow.operators.spatial_join import point_cells
        levels = tuple(r[0] for r in c.select("level").distinct().collect())
        return point_cells(points, "lon", "lat", levels, 1.0).join(c.where(~F.col("inside")), ["level", "cx", "cy"]).count()

    assert tested(fine) < tested(cells) / 2


def test_join_plan_has_no_nested_loop(spark):
    regions = _regions(spark, [_poly(SQUARE)])
    points = spark.createDataFrame([(1, 1.0, 1.0)], "pid int, lon double, lat double")
    for bcast in (10**9, 0):
        plan = within_join(points, regions, broadcast_max_edges=bcast,
                           broadcast_max_cells=bcast)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def _source(spark, texts):
    return spark.createDataFrame([(i, f"r{i}", t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)], REGION_SOURCE)


def test_geometries_that_cannot_be_used_are_set_aside(spark):
    bad = {"json invalide": [None, "", "{", "no"], "type inconnu": [{"type": "Circle", "coordinates": [1, 2]}, "{}", "[]", "null", {"type": "Feature", "geometry": None}],
           "coordonnées invalides": [{"type": "Point"}, {"type": "Point", "coordinates": [1]}, {"type": "Polygon", "coordinates": [[[0, 0], [1, "x"], [1, 1]]]},
                                     {"type": "Polygon", "coordinates": [[[0, 0], [1, None], [1, 1]]]}, {"type": "LineString", "coordinates": [1, 2]}],
           "contour sans surface": [_poly([(0, 0), (1, 1), (0, 0)]), _poly([(0, 0), (0.1, 0.1), (0.3, 0.3), (0, 0)]), _poly(SQUARE, [])],
           "ligne sans longueur": [{"type": "LineString", "coordinates": [[1, 1], [1, 1]]}]}
    texts = [(why, t) for why, ts in bad.items() for t in ts]
    good = [_poly(SQUARE), {"type": "Point", "coordinates": [1, 2, 3]}, {"type": "GeometryCollection", "geometries": []}, {"type": "MultiPolygon", "coordinates": []}]
    source = _source(spark, [t for _, t in texts] + good)
    assert {r["id"]: r["reasons"] for r in rejected_regions(source).collect()} == {i: [why] for i, (why, _) in enumerate(texts)}
    kept = {r["id"]: r for r in region_table(source).collect()}
    assert sorted(kept) == list(range(len(texts), len(texts) + len(good)))
    points = spark.createDataFrame([(1, 1.0, 2.0)], "pid int, lon double, lat double")
    assert _pairs(within_join(points, region_table(source))) == [(1, len(texts)), (1, len(texts) + 1)]


def test_every_geometry_type(spark):
    line = {"type": "LineString", "coordinates": [[0, 0], [2, 2], [4, 0]]}
    two = [_poly(SQUARE), _poly([(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)])]
    shapes = [
        line,
        {"type": "MultiLineString", "coordinates": [[[0, 0], [2, 2]], [[2, 2], [4, 0]]]},
        {"type": "LineString", "coordinates": [[0, 0], [4, 0], [4, 4], [0, 0]]},
        {"type": "MultiPoint", "coordinates": [[1, 1], [9, 9]]},
        {"type": "MultiPolygon", "coordinates": [p["coordinates"] for p in two]},
        {"type": "GeometryCollection", "geometries": [_poly(HOLE), {"type": "GeometryCollection", "geometries": [line, {"type": "Point", "coordinates": [9, 9]}]}]},
        {"type": "Feature", "properties": {}, "geometry": _poly(TRIANGLE)},
        {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": p} for p in two]},
    ]
    points = [(1, 1, 1), (2, 2, 2), (3, 0, 0), (4, 4, 0), (5, 3, 3), (6, 9, 9), (7, 12, 1), (8, 5, 5), (9, 6, 4), (10, 2, 0), (11, 3, 1), (12, 2, 3)]
    got = {}
    for pid, region in _pairs(within_join(spark.createDataFrame([(i, float(x), float(y)) for i, x, y in points], "pid int, lon double, lat double"),
                                          region_table(_source(spark, shapes)), cell=0.5)):
        got.setdefault(region, []).append(pid)
    assert got == {
        0: [1, 2, 11],               # inside the line; its two ends are its boundary
        1: [1, 2, 11],               # (2,2) ends two lines: no boundary
        2: [1, 2, 3, 4, 5, 10],      # a closed line has no boundary
        3: [1, 6],
        4: [1, 2, 5, 8, 11, 12],     # (2,3) lies on the second square's side, inside the first
        5: [1, 2, 6, 11],            # the square's corner (1,1) and the point (3,1) are on the line
        6: [7],
        7: [1, 2, 5, 8, 11, 12],
    }


def test_sides_are_never_wrong(spark):
    """Random and nearly collinear points on and beside sloped edges against rational arithmetic."""
    from fractions import Fraction
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        kind = rng.randint(0, 3)
        x1, y1, x2, y2 = (rng.uniform(-180, 180) if kind < 2 else rng.randint(-9, 9) / 10 for _ in range(4))
        t = rng.choice([0.5, 0.25, rng.random(), 1 / 3, 1.0, 0.0])
        px, py = x1 + (x2 - x1) * t, y1 + (y2 - y1) * t
        if kind % 2:
            # beside the edge by a last place (of a zero that would be a denormal number)
            px, py = rng.choice([px, math.nextafter(px, 999) if px else px]), rng.choice([py, math.nextafter(py, -999) if py else py])
        rows.append((float(x1), float(y1), float(x2), float(y2), px, py))
    rows += [(0.1, 0.1, 0.3, 0.3, 0.2, 0.2), (1e-100, 0.0, 1.0, 1e-8, 0.5, 5e-9), (0.0, 0.0, 3.0, 1.0, 0.3, 0.1)]
    sign = geo.orientation(*[F.col(c) for c in ("x1", "y1", "x2", "y2", "px", "py")])
    got = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double, px double, py double").select("*", sign.alias("s")).collect()
    zero = 0
    for r in got:
        x1, y1, x2, y2, px, py = (Fraction(v) for v in tuple(r)[:6])
        det = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
        assert r["s"] == (det > 0) - (det < 0)
        zero += det == 0
    assert zero > 100 and len(got) - zero > 1000


def test_points_on_sloped_edges_are_out(spark):
    """Polygons on a fine lattice with sloped sides: every lattice point on a side or corner is out, exactly as rationals say."""
    from fractions import Fraction
    rng = random.Random(8)
    polys, rings = [], []
    for _ in range(10):
        ring = [(rng.randint(0, 30) / 10, rng.randint(0, 30) / 10) for _ in range(rng.randint(3, 6))]
        if len(set(ring)) < 3 or all((ring[1][0] - ring[0][0]) * (p[1] - ring[0][1]) == (ring[1][1] - ring[0][1]) * (p[0] - ring[0][0]) for p in ring):
            continue
        polys.append(_poly([*ring, ring[0]]))
        rings.append([[(Fraction(x), Fraction(y)) for x, y in [*ring, ring[0]]]])
    pts = [(i * 31 + j, i / 10, j / 10) for i in range(31) for j in range(31)]
    regions = _regions(spark, polys)
    ids = sorted(r["id"] for r in regions.collect())
    points = spark.createDataFrame(pts, "pid int, lon double, lat double")
    got = _pairs(within_join(points, regions, cell=0.5))

    def inside(px, py, ring):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            side = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
            if side == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by):
                return False
            if (ay <= py < by and side > 0) or (by <= py < ay and side < 0):
                odd = not odd
        return odd

    assert got == sorted((pid, k + 1) for pid, x, y in pts for k, s in enumerate(rings)
                         if k + 1 in ids and inside(Fraction(x), Fraction(y), s[0]))


def test_grid_cell_text_values(spark):
    df = spark.createDataFrame([(11, 88), (10, 103), (0, -5), (-12, 0)], "gx long, gy long")
    got = [r[0] for r in df.select(geo.grid_cell_text(F.col("gx"), F.col("gy"), 0.1)).collect()]
    assert got == ["POINT(1.1 8.8)", "POINT(1 10.3)", "POINT(0 -0.5)", "POINT(-1.2 0)"]


def test_keep_all_regions_reports_every_region(spark):
    from civicflow import catalog
    from civicflow.plans import analytics
    from conftest import SMALL
    ev = catalog.spatial_events(spark, SMALL)
    strict = {r[0]: r[1] for r in analytics.events_per_region(ev, catalog.regions(spark), catalog.AS_OF).collect()}
    every = {r[0]: r[1] for r in analytics.events_per_region(ev, catalog.regions(spark), catalog.AS_OF,
                                                             keep_all_regions=True).collect()}
    assert "OLD_ONLY" not in strict and every["OLD_ONLY"] == 0
    assert all(every[k] == v for k, v in strict.items())
