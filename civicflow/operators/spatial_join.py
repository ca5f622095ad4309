"""Point-in-polygon join (``ST_Within``) as a grid equi-join.

A bare bounding-box predicate makes Spark plan a nested-loop join.  Instead
each region is cut into the grid cells its bounding box covers and each
point is given the cell it falls in, so the join is an equi-join on
``(level, cx, cy)`` followed by the exact test on the few candidate pairs:

1. regions: bbox → cells.  Each region picks the finest level (cell size
   ``cell * 2**level``) at which it covers at most ``max_cells`` cells, so a
   country and a street block both stay small.
2. points: one cell per level in use (usually one or two levels).
3. equi-join.  Cells wholly inside a region match at once; cells its
   outline crosses get the region's edges (joined by region id) and the
   even-odd crossing test with boundary exclusion; cells wholly outside were
   dropped.  A point has one cell per level and a region one level, so a
   (point, region) pair can only meet once: no distinct.

Each region-side table is broadcast only when its size, counted before the
join, is under its threshold (cells, edges); otherwise that join is
hash-partitioned and AQE splits hot cells or hot regions (skew join).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.functions import geo
from civicflow.operators.parallel import spread
from civicflow.session import scratch

DEFAULT_CELL = 0.25
DEFAULT_MAX_CELLS = 64
# bytes of a broadcast region side, and of an edge and of a cell in it, at most: an edge is a struct of four doubles in
# an array, a cell a row of four numbers and a flag in a hash table
BROADCAST_BYTES = 128 << 20
EDGE_BYTES, CELL_BYTES = 64, 96
DEFAULT_BROADCAST_MAX_EDGES = BROADCAST_BYTES // EDGE_BYTES
DEFAULT_BROADCAST_MAX_CELLS = BROADCAST_BYTES // CELL_BYTES
MAX_CELLS_COMPLEX = 4096
MAX_LEVEL = 30
# cells that are divided at most, and how often each is halved at most
MAX_HOT = 10_000
MAX_SPLIT = 6
# share of the points that hot cells are told from
SAMPLE_RATE = 0.01


REGION_COLUMNS = ("parts", "lines", "ends", "dots", "bbox")


def read_shapes(source: DataFrame) -> DataFrame:
    """``(id, name, geojson)`` → ``(id, name, geojson, shape, reasons)``; the reasons say why a geometry cannot be used.

    The rows come out of generators, so that no later expression or filter
    runs the GeoJSON parsing again.
    """
    found = source.select("id", "name", "geojson", F.inline(F.array(F.struct(geo.geometries(F.col("geojson")).alias("found")))))
    shaped = found.select(F.inline(F.array(F.struct("id", "name", "geojson", F.when(F.col("found").isNotNull(), geo.shapes(F.col("found"))).alias("shape")))))
    return shaped.select(F.inline(F.array(F.struct("id", "name", "geojson", "shape", geo.invalid_reasons(F.col("shape")).alias("reasons")))))


def region_table(source: DataFrame) -> DataFrame:
    """``(id, name, geojson)`` → ``(id, name, parts, lines, ends, dots, bbox)`` of the regions whose geometry can be used.

    Geometries of every type are read, features and collections too.  Those
    that cannot be used are in :func:`rejected_regions`.
    """
    shapes = read_shapes(source).where(F.size("reasons") == 0)
    return shapes.select(F.inline(F.array(F.struct("id", "name", *geo.region_columns(F.col("shape"))))))


def rejected_regions(source: DataFrame) -> DataFrame:
    """``(id, name, reasons)`` of the regions that :func:`region_table` leaves out."""
    return read_shapes(source).where(F.size("reasons") > 0).select("id", "name", "reasons")


def _cell_size(cell: float, level: Column) -> Column:
    return F.lit(cell) * F.pow(F.lit(2.0), level.cast("double"))


def _cell_count(bbox: Column, size: Column) -> Column:
    nx = F.floor(bbox["x1"] / size) - F.floor(bbox["x0"] / size) + 1
    ny = F.floor(bbox["y1"] / size) - F.floor(bbox["y0"] / size) + 1
    return nx * ny


def _touching_edges(edges: Column, size: Column, cx: Column, cy: Column) -> Column:
    """Edges whose bounding box meets the (slightly grown) closed cell.

    Conservative: an edge that merely comes close is kept, which only costs
    an exact test; an edge that crosses the cell is never missed.
    """
    x0, y0 = cx * size, cy * size
    x1, y1 = x0 + size, y0 + size
    eps = size * F.lit(1e-9) + F.lit(1e-12)
    return F.filter(edges, lambda e: (
        (F.least(e["x1"], e["x2"]) <= x1 + eps) & (F.greatest(e["x1"], e["x2"]) >= x0 - eps)
        & (F.least(e["y1"], e["y2"]) <= y1 + eps) & (F.greatest(e["y1"], e["y2"]) >= y0 - eps)))


def region_cells(regions: DataFrame, cell: float = DEFAULT_CELL, max_cells: int = DEFAULT_MAX_CELLS) -> DataFrame:
    """One row per (region, cell) where the region may hold points of the cell.

    Each cell is classified once, on the small side:

    * boundary: some edge touches it; its points get the exact test;
    * interior: no edge touches it and its centre is inside, so every point
      in it is strictly inside (``inside = true``);
    * exterior: no edge touches it and its centre is outside; dropped.

    A region gets the finest level with at most ``max_cells`` cells, or up
    to one cell per edge (capped at ``MAX_CELLS_COMPLEX``) for a detailed
    outline, so most of its points fall in interior cells.  Cells carry no
    geometry: :func:`region_geometry` holds each region's edges once.
    """
    regions = regions.withColumn("edges", geo.outline(F.col))
    cap = F.greatest(F.lit(max_cells), F.least(F.size("edges"), F.lit(MAX_CELLS_COMPLEX)))
    level = F.array_min(F.filter(
        F.sequence(F.lit(0), F.lit(MAX_LEVEL)),
        lambda lv: _cell_count(F.col("bbox"), _cell_size(cell, lv)) <= cap))
    with_level = (regions.where(F.col("bbox").isNotNull() & (F.size("edges") > 0))
                  .withColumn("level", F.coalesce(level, F.lit(MAX_LEVEL))))
    size = _cell_size(cell, F.col("level"))
    b = F.col("bbox")
    return _classified(with_level.withColumnRenamed("id", "region_id")
                       .withColumn("cx", F.explode(F.sequence(F.floor(b["x0"] / size), F.floor(b["x1"] / size))))
                       .withColumn("cy", F.explode(F.sequence(F.floor(b["y0"] / size), F.floor(b["y1"] / size)))), cell)


def _classified(cells: DataFrame, cell: float) -> DataFrame:
    """(region_id, level, cx, cy, inside) of the cells that may hold points of their region; ``cells`` has the region's columns and edges."""
    size = _cell_size(cell, F.col("level"))
    touching = _touching_edges(F.col("edges"), size, F.col("cx"), F.col("cy"))
    centre_x = (F.col("cx") + F.lit(0.5)) * size
    centre_y = (F.col("cy") + F.lit(0.5)) * size
    classified = cells.select(
        "region_id", "level", "cx", "cy",
        (F.size(touching) > 0).alias("boundary"),
        geo.within(centre_x, centre_y, F.col).alias("centre_in"))
    return (classified.where(F.col("boundary") | F.col("centre_in"))
            .select("region_id", "level", "cx", "cy", (~F.col("boundary")).alias("inside")))


def hot_cells(points: DataFrame, cells: DataFrame, lon: str, lat: str, cell: float, hot_points: int, rate: float = SAMPLE_RATE) -> DataFrame:
    """(level, cx, cy, split): boundary cells that a sample of the points says hold more than ``hot_points``.

    ``split`` is how often a cell is to be halved in both directions so that
    its quarters of quarters hold about that many.  At most ``MAX_HOT`` cells,
    the fullest first; the choice changes the plan, never the result.
    """
    edge = cells.where(~F.col("inside")).select("level", "cx", "cy").distinct()
    levels = tuple(sorted(r["level"] for r in edge.select("level").distinct().collect()))
    sampled = point_cells(points.select(lon, lat).sample(rate, seed=1) if rate < 1 else points.select(lon, lat), lon, lat, levels, cell)
    full = (sampled.groupBy("level", "cx", "cy").agg((F.count("*") / rate).alias("n")).where(F.col("n") > hot_points)
            .join(edge, ["level", "cx", "cy"], "left_semi").orderBy(F.desc("n"), "level", "cx", "cy").limit(MAX_HOT))
    split = F.least(F.ceil(F.log(4.0, F.col("n") / hot_points)), F.lit(MAX_SPLIT)).cast("int")
    return full.select("level", "cx", "cy", split.alias("split"))


def refined(cells: DataFrame, regions: DataFrame, hot: DataFrame, cell: float) -> DataFrame:
    """The cells with the hot ones among the boundary cells divided: quadtree descendants, classified anew.

    Cells nest exactly: their sizes differ by powers of two, so a point lies
    in one descendant of its cell and in no other cell of the region.
    """
    marked = cells.join(F.broadcast(hot), ["level", "cx", "cy"], "left")
    divide = F.col("split").isNotNull() & ~F.col("inside")
    n = F.pow(F.lit(2), F.col("split")).cast("long")
    parts = (marked.where(divide)
             .withColumn("cx", F.explode(F.sequence(F.col("cx") * n, F.col("cx") * n + n - 1)))
             .withColumn("cy", F.explode(F.sequence(F.col("cy") * n, F.col("cy") * n + n - 1)))
             .withColumn("level", F.col("level") - F.col("split")).drop("inside", "split"))
    shaped = regions.withColumnRenamed("id", "region_id").withColumn("edges", geo.outline(F.col))
    return marked.where(~divide).drop("split").unionByName(_classified(parts.join(shaped, "region_id"), cell))


def region_geometry(regions: DataFrame) -> DataFrame:
    """``(region_id, parts, lines, ends, dots, bbox)``: each region's outline, once."""
    return regions.select(F.col("id").alias("region_id"), *REGION_COLUMNS)


@dataclass(frozen=True)
class CellStats:
    levels: tuple[int, ...]
    cells: int
    edges: int


def cell_stats(cells: DataFrame, geometry: DataFrame) -> CellStats:
    """Size of the region side, measured before choosing the join strategy.

    Two small aggregations on the (small) region side, run as one job; the
    result is a handful of numbers, never the regions themselves.
    """
    on_cells = cells.agg(F.lit("cells").alias("side"), F.sort_array(F.collect_set("level")).alias("levels"),
                         F.count(F.lit(1)).alias("n"))
    on_edges = geometry.agg(F.lit("edges").alias("side"), F.array().cast("array<int>").alias("levels"),
                            F.coalesce(F.sum(F.size(geo.outline(F.col))), F.lit(0)).alias("n"))
    rows = {r["side"]: r for r in on_cells.unionByName(on_edges).collect()}  # two rows, one job
    return CellStats(tuple(rows["cells"]["levels"] or ()), int(rows["cells"]["n"]), int(rows["edges"]["n"]))


def point_cells(points: DataFrame, lon: str, lat: str, levels: tuple[int, ...], cell: float) -> DataFrame:
    """Adds ``level, cx, cy``: one row per point and level in use."""
    if not levels:
        return points.withColumn("level", F.lit(None).cast("int")) \
            .withColumn("cx", F.lit(None).cast("long")).withColumn("cy", F.lit(None).cast("long"))
    keys = [F.struct(F.lit(lv).alias("level"),
                     F.floor(F.col(lon) / F.lit(cell * 2.0 ** lv)).alias("cx"),
                     F.floor(F.col(lat) / F.lit(cell * 2.0 ** lv)).alias("cy")) for lv in levels]
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    return (points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
            .withColumn("_cell", key)
            .select("*", "_cell.level", "_cell.cx", "_cell.cy").drop("_cell"))


def within_join(points: DataFrame, regions: DataFrame, lon: str = "lon", lat: str = "lat",
                cell: float = DEFAULT_CELL, max_cells: int = DEFAULT_MAX_CELLS,
                broadcast_max_edges: int = DEFAULT_BROADCAST_MAX_EDGES,
                broadcast_max_cells: int = DEFAULT_BROADCAST_MAX_CELLS,
                stats: CellStats | None = None, hot_points: int | None = None, sample_rate: float = SAMPLE_RATE) -> DataFrame:
    """Inner join of points with every region that strictly contains them.

    ``regions`` is the output of :func:`region_table`; the result has the
    point columns plus ``region_id``.  Points in interior cells are matched
    by the cell join alone; only points in boundary cells meet the region's
    edges, through a second join on ``region_id``: with the outlines
    broadcast in the same pass, else for the boundary points alone.

    ``stats`` may be passed when already measured for a superset of
    ``regions`` (its counts bound the subset's; its levels cover them).

    ``hot_points``: boundary cells that hold more points than that, by a
    sample, are divided until they do not, so that few of the points of a busy
    place at a border need the exact test, and no key holds many.
    """
    cells = region_cells(regions, cell, max_cells)
    if hot_points is not None:
        # written once: every use sees one choice of cells
        folder = scratch(points.sparkSession, "cells")
        refined(cells, regions, hot_cells(points, cells, lon, lat, cell, hot_points, sample_rate), cell).write.parquet(folder)
        cells, stats = points.sparkSession.read.schema(cells.schema).parquet(folder), None
    geometry = region_geometry(regions)
    if stats is None:
        stats = cell_stats(cells, geometry)
    pts = point_cells(spread(points), lon, lat, stats.levels, cell)
    cell_side = F.broadcast(cells) if stats.cells <= broadcast_max_cells else cells
    geo_side = F.broadcast(geometry) if stats.edges <= broadcast_max_edges else geometry
    if stats.edges > broadcast_max_edges:
        # outlines are shuffled by region: only points of boundary cells go there, interior ones are matched already
        keep = [*points.columns, "region_id"]
        inner = pts.join(cell_side.where("inside"), ["level", "cx", "cy"], "inner").select(*keep)
        edge = pts.join(cell_side.where(~F.col("inside")), ["level", "cx", "cy"], "inner").join(geo_side, "region_id")
        exact = geo.in_bbox(F.col(lon), F.col(lat), F.col("bbox")) & geo.within(F.col(lon), F.col(lat), F.col)
        return inner.unionByName(edge.where(exact).select(*keep))
    candidates = pts.join(cell_side, ["level", "cx", "cy"], "inner")
    g = geo_side.alias("g")
    with_geometry = candidates.join(
        g, (candidates["region_id"] == F.col("g.region_id")) & ~candidates["inside"], "left_outer")
    px, py = candidates[lon], candidates[lat]
    exact = candidates["inside"] | (geo.in_bbox(px, py, F.col("g.bbox")) & geo.within(px, py, lambda c: F.col(f"g.{c}")))
    keep = [c for c in candidates.columns if c not in ("level", "cx", "cy", "inside")]
    return with_geometry.where(exact).select(*[candidates[c] for c in keep])
