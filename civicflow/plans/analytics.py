"""The analytical queries over the spatial events table.

Each takes the events table as ``(id, ts, geom struct<lon,lat>, value,
category, source)`` and an ``as_of`` instant (the reference's ``NOW()``,
made a parameter so results do not move).
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.functions import geo
from civicflow.operators.rollup import Rollup
from civicflow.operators.spatial_join import cell_stats, region_cells, region_geometry, within_join
from civicflow.session import shared_dir
from civicflow.sinks.snapshots import Snapshot

# Analysis windows and grid size of the reference queries.
DAILY_WINDOW_DAYS = 30
REGION_WINDOW_DAYS = 30
HOTSPOT_WINDOW_DAYS = 7
HOTSPOT_GRID = 0.1
HOTSPOT_TOP = 5
# boxes of single regions that are pushed into a scan, at most
MAX_BOXES = 64


def cutoff(as_of: str | datetime, days: int):
    """``as_of - INTERVAL 'n days'`` as a ``timestamp_ntz`` literal."""
    t = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return F.lit((t - timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")


def in_window(events: DataFrame, since, keep_undated: bool = False) -> DataFrame:
    """``ts >= since`` (or ts NULL when ``keep_undated``), plus the same bound
    on the ``date`` partition column when the table has one, so whole days
    are pruned before any file is opened."""
    cond = F.col("ts") >= since
    if keep_undated:
        cond = cond | F.col("ts").isNull()
    if "date" in events.columns:
        day = F.col("date") >= F.to_date(since)
        cond = cond & ((day | F.col("date").isNull()) if keep_undated else day)
    return events.where(cond)


def _exact_sum_as_double(value_col: str) -> F.Column:
    return F.sum(F.col(value_col).cast("decimal(38,10)")).cast("double")


def daily_avg(events: DataFrame, as_of: str, days: int = DAILY_WINDOW_DAYS) -> DataFrame:
    """A1 + O1: mean value per (day, category) over the trailing window."""
    recent = in_window(events, cutoff(as_of, days))
    return (recent.groupBy(F.to_date("ts").alias("event_date"), "category")
            .agg(_exact_sum_as_double("value").alias("_sum"), F.count("value").alias("_n"))
            # AVG of only NULL values is NULL (no division by zero under ANSI)
            .select("event_date", "category",
                    F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).alias("avg_value"))
            .orderBy(F.col("event_date").desc_nulls_last(), F.col("category").asc_nulls_last()))


_SUM = T.DecimalType(38, 10)


def daily_sums(events: Snapshot, path: str) -> Rollup:
    """A1's sums by (day, category), kept current with the events table."""
    return Rollup(events, path,
                  {"event_date": (T.DateType(), lambda: F.to_date("ts")), "category": (T.StringType(), lambda: F.col("category"))},
                  {"total": (_SUM, lambda: F.col("value")), "n": (T.LongType(), lambda: F.col("value").isNotNull().cast("long"))})


def cell_sums(events: Snapshot, path: str, grid: float = HOTSPOT_GRID) -> Rollup:
    """A3's sums by (day, grid cell), kept current with the events table."""
    return Rollup(events, path,
                  {"event_date": (T.DateType(), lambda: F.to_date("ts")), "gx": (T.LongType(), lambda: geo.snap_index(F.col("geom.lon"), grid)),
                   "gy": (T.LongType(), lambda: geo.snap_index(F.col("geom.lat"), grid))},
                  {"total": (_SUM, lambda: F.col("value")), "n": (T.LongType(), lambda: F.col("value").isNotNull().cast("long"))})


def window_sums(rollup: Rollup, as_of: str, days: int) -> DataFrame:
    """The rollup's groups of the trailing window: whole days from the sums, the day that the window begins in from its rows."""
    since = cutoff(as_of, days)
    events = rollup.source.read()
    first = F.to_date(since)
    whole = rollup.read().where((F.col("event_date") > first) | ((F.col("event_date") == first) & (since == first.cast("timestamp_ntz"))))
    begun = events.where((F.col("date") == first) & (F.col("ts") >= since) & (since != first.cast("timestamp_ntz")))
    return whole.unionByName(rollup.sums(begun))


def daily_avg_maintained(rollup: Rollup, as_of: str, days: int = DAILY_WINDOW_DAYS) -> DataFrame:
    """A1 + O1 from maintained sums."""
    return (window_sums(rollup, as_of, days)
            .select("event_date", "category", F.when(F.col("n") > 0, F.col("total").cast("double") / F.col("n")).alias("avg_value"))
            .orderBy(F.col("event_date").desc_nulls_last(), F.col("category").asc_nulls_last()))


def hotspots_maintained(rollup: Rollup, as_of: str, days: int = HOTSPOT_WINDOW_DAYS, grid: float = HOTSPOT_GRID,
                        top: int = HOTSPOT_TOP) -> DataFrame:
    """A3 + O3 from maintained sums."""
    cells = (window_sums(rollup, as_of, days).groupBy("gx", "gy")
             .agg(F.when(F.sum("n") > 0, F.sum("total").cast("double")).alias("total_value"), F.sum("rows").alias("event_count")))
    return _top_cells(cells, grid, top)


def hotspots(events: DataFrame, as_of: str, days: int = HOTSPOT_WINDOW_DAYS, grid: float = HOTSPOT_GRID,
             top: int = HOTSPOT_TOP) -> DataFrame:
    """A3 + O3: grid cells with the highest total value in the window.

    Partial aggregation per cell, then a bounded top-k (each task keeps its
    best ``top`` cells).  Ties are broken by cell so the result is stable.
    """
    recent = in_window(events, cutoff(as_of, days))
    gx = geo.snap_index(F.col("geom.lon"), grid)
    gy = geo.snap_index(F.col("geom.lat"), grid)
    cells = (recent.select(gx.alias("gx"), gy.alias("gy"), "value")
             .groupBy("gx", "gy")
             .agg(_exact_sum_as_double("value").alias("total_value"), F.count(F.lit(1)).alias("event_count")))
    return _top_cells(cells, grid, top)


def _top_cells(cells: DataFrame, grid: float, top: int) -> DataFrame:
    return (cells.orderBy(F.col("total_value").desc_nulls_first(), F.col("gx").asc_nulls_first(),
                          F.col("gy").asc_nulls_first())
            .limit(top)
            .select(geo.grid_cell_text(F.col("gx"), F.col("gy"), grid).alias("grid_cell"),
                    "gx", "gy", "total_value", "event_count"))


def events_per_region(events: DataFrame, regions: DataFrame, as_of: str, days: int = REGION_WINDOW_DAYS,
                      keep_all_regions: bool = False, **join_options) -> DataFrame:
    """A2 + J1 + P9 + O2: events strictly inside each region in the window.

    Reference semantics of ``regions LEFT JOIN events … WHERE ts >= cutoff OR
    ts IS NULL``: a region without any event is kept with 0, an in-region
    event without timestamp counts, and a region whose events are all older
    than the cutoff is dropped.

    Two phases, so that the usual case reads only the window:

    1. window (and undated) events → count per region, with partition and
       row-group pruning on the time bound;
    2. only regions with no window event need the history, to tell "never
       had an event" (kept with 0) from "only old events" (dropped).  Their
       bounding boxes are pushed into the scan of the older events, each by
       itself, so quiet regions far apart do not read what lies between;
       when every region has window events this phase reads nothing.

    ``keep_all_regions=True`` skips phase 2 and reports every region.
    """
    since = cutoff(as_of, days)
    recent = in_window(events, since, keep_undated=True)
    pts = recent.select("id", "ts", F.col("geom.lon").alias("lon"), F.col("geom.lat").alias("lat"))
    cell_opts = {k: v for k, v in join_options.items() if k in ("cell", "max_cells")}
    stats = cell_stats(region_cells(regions, **cell_opts), region_geometry(regions))
    per_region = (within_join(pts, regions, "lon", "lat", stats=stats, **join_options)
                  .groupBy("region_id").agg(F.count("id").alias("passing")))
    if not keep_all_regions:
        # one row per region, needed by phase 2 and by the result: computed
        # once and kept in the shared checkpoint folder
        shared_dir(events.sparkSession)
        per_region = per_region.checkpoint()
    joined = regions.select("id", "name").join(per_region, F.col("id") == F.col("region_id"), "left")
    if not keep_all_regions:
        quiet = regions.join(per_region, F.col("id") == F.col("region_id"), "left_anti")
        # the quiet regions' boxes, a few in the usual case; one box around all of them beyond MAX_BOXES
        boxes = [r["bbox"] for r in quiet.select("bbox").limit(MAX_BOXES + 1).collect()]
        if len(boxes) > MAX_BOXES:
            boxes = [quiet.agg(F.min("bbox.x0").alias("x0"), F.max("bbox.x1").alias("x1"),
                               F.min("bbox.y0").alias("y0"), F.max("bbox.y1").alias("y1")).first()]
        boxes = [b for b in boxes if b is not None and b["x0"] is not None]
        if boxes:
            old = events.where(F.col("ts") < since)
            if "date" in events.columns:
                old = old.where(F.col("date") <= F.to_date(since))
            lon, lat = F.col("geom.lon"), F.col("geom.lat")
            near = reduce(or_, [lon.between(b["x0"], b["x1"]) & lat.between(b["y0"], b["y1"]) for b in boxes])
            old_pts = (old.where(near)
                       .select("id", lon.alias("lon"), lat.alias("lat")))
            # the quiet regions are a subset: the size check above covers them
            had_old = (within_join(old_pts, quiet, "lon", "lat", stats=stats, **join_options)
                       .select(F.col("region_id").alias("old_region")).distinct())
            joined = (joined.join(had_old, F.col("id") == F.col("old_region"), "left")
                      .where(F.col("passing").isNotNull() | F.col("old_region").isNull()))
    return (joined.select(F.col("name").alias("region_name"),
                          F.coalesce(F.col("passing"), F.lit(0)).cast("long").alias("event_count"))
            .orderBy(F.col("event_count").desc(), F.col("region_name").asc()))


def points_per_region(points: DataFrame, regions: DataFrame, lon: str = "lon", lat: str = "lat",
                      **join_options) -> DataFrame:
    """Points (e.g. citizen reports) per region, every region kept."""
    pairs = within_join(points.select(lon, lat), regions, lon, lat, **join_options)
    counts = pairs.groupBy("region_id").agg(F.count(F.lit(1)).alias("n"))
    return (regions.select("id", "name").join(counts, F.col("id") == F.col("region_id"), "left")
            .select(F.col("name").alias("region_name"), F.coalesce(F.col("n"), F.lit(0)).alias("report_count"))
            .orderBy(F.col("report_count").desc(), F.col("region_name").asc()))
