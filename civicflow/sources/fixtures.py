"""Inputs in the reference's shapes, derived by Spark from the given tables.

The reference ships no sample data; these derivations of ``events``
(FIXTURES.md) give every job input the shape it expects, and they grow
with the events table: each is a projection of it, no row is made up.

* ``ev_geo``   – geolocated events (the spatial events table, before typing)
* ``raw_ev``   – a dirty bronze copy with out-of-range and unparseable fields
* ``docs``     – citizen report JSON documents in nine layouts
* ``regions``  – the only fixed input: four GeoJSON rectangles (a dimension
  table; the point side of every spatial job is the events table)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.functions.common import idiv, ntz
from civicflow.operators.parallel import dealt
from civicflow.schemas import REGION_SOURCE

EVENTS_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")

# Fixed values of the fixture definitions (FIXTURES.md).
AS_OF = "2024-02-01 00:00:00"
HOT_POINT = (5.5, 8.5)  # lon, lat given to every 40th event of the first day
DAY_ONE_END = "2024-01-02 00:00:00"
REGION_RECTANGLES = (
    (1, "RECT_SOUTH", 0.0, 2.0, 6.0, 7.0),
    (2, "RECT_OVERLAP", 1.0, 2.0, 6.5, 8.0),
    (3, "EMPTY", 20.0, 21.0, 20.0, 21.0),
    (4, "OLD_ONLY", 5.0, 6.0, 8.0, 9.0),
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events").select(*EVENTS_COLUMNS)


def _dbl(n: int | float) -> Column:
    return F.lit(float(n))


def geo_columns(event_id: Column, ts: Column) -> tuple[Column, Column]:
    hot = ((event_id % 40) == 0) & (ts < ntz(DAY_ONE_END))
    lon = F.when(hot, _dbl(HOT_POINT[0])).otherwise(((event_id * 7919) % 2000003).cast("double") / _dbl(1e6))
    lat = F.when(hot, _dbl(HOT_POINT[1])).otherwise(
        _dbl(6) + ((event_id * 104729) % 5000011).cast("double") / _dbl(1e6))
    return lon, lat


def ev_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, ts, longitude, latitude, value, category, source."""
    e = events(spark, sf_dir)
    lon, lat = geo_columns(F.col("event_id"), F.col("ts"))
    return e.select(
        F.col("event_id").alias("id"), "ts", lon.alias("longitude"), lat.alias("latitude"), "value",
        F.col("event_type").alias("category"),
        F.concat(F.lit("src_"), (F.col("user_id") % 4).cast("string")).alias("source"))


def raw_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty bronze events; ``ds`` is the landing day (day of the clean ts)."""
    g = dealt(ev_geo(spark, sf_dir))
    i = F.col("id")
    return g.select(
        i.cast("string").alias("id"),
        F.when(i % 101 == 0, F.lit(None)).otherwise(F.col("ts")).cast("timestamp_ntz").alias("ts"),
        F.when(i % 50 == 0, _dbl(95)).when(i % 53 == 0, F.lit(None).cast("double"))
         .when(i % 59 == 0, _dbl(90)).otherwise(F.col("latitude")).alias("latitude"),
        F.when(i % 75 == 0, _dbl(-190)).when(i % 61 == 0, _dbl(-180))
         .otherwise(F.col("longitude")).alias("longitude"),
        F.when(i % 60 == 0, F.lit("abc")).when(i % 90 == 1, F.lit("-1.5")).when(i % 67 == 0, F.lit("0"))
         .when(i % 71 == 0, F.lit(None).cast("string")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(i % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("category")).alias("category"),
        "source",
        F.to_date("ts").alias("ds"),
    )


def region_source(spark: SparkSession) -> DataFrame:
    """id, name, GeoJSON polygon text."""
    rows = []
    for rid, name, x0, x1, y0, y1 in REGION_RECTANGLES:
        ring = [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]
        coords = "[[" + ",".join(f"[{x},{y}]" for x, y in ring) + "]]"
        rows.append(F.struct(F.lit(rid).alias("id"), F.lit(name).alias("name"),
                             F.lit('{"type":"Polygon","coordinates":' + coords + "}").alias("geojson")))
    # a local relation built in the JVM (no Python worker for four rows)
    return spark.range(1).select(F.inline(F.array(*rows))).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in REGION_SOURCE.fields])


def event_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, geojson: a region for each twelfth of the users, placed where their events begin.

    Two squares that overlap, a square with a hole, the point of an event; the
    last two cannot be used: an outline without area, and no known type.
    """
    e = events(spark, sf_dir)
    lon, lat = geo_columns(F.col("event_id"), F.col("ts"))
    g = F.col("user_id") % 12
    of = e.select(g.cast("int").alias("g"), "event_id", lon.alias("lon"), lat.alias("lat")).groupBy("g").agg(
        F.min("lon").alias("x"), F.min("lat").alias("y"), F.min_by("lon", "event_id").alias("px"), F.min_by("lat", "event_id").alias("py"))
    x, y = F.col("x") + _dbl(0.0625) * F.col("g"), F.col("y") + _dbl(0.125) * F.col("g")

    def ring(x0: float, x1: float, y0: float, y1: float) -> Column:
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return F.concat(F.lit("["), F.concat_ws(",", *[F.concat(F.lit("["), (x + _dbl(a)).cast("string"), F.lit(","), (y + _dbl(b)).cast("string"), F.lit("]"))
                                                       for a, b in corners]), F.lit("]"))

    def geojson(kind: str, *coordinates: Column | str) -> Column:
        return F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), *[F.lit(c) if isinstance(c, str) else c for c in coordinates], F.lit("}"))

    point = F.concat(F.lit("["), F.col("px").cast("string"), F.lit(","), F.col("py").cast("string"), F.lit("]"))
    text = (F.when(F.col("g") < 6, geojson("MultiPolygon", "[[", ring(0.0, 0.5, 0.0, 2.0), "],[", ring(0.25, 0.75, 1.0, 3.0), "]]"))
            .when(F.col("g") < 9, geojson("Polygon", "[", ring(0.0, 1.0, 0.0, 3.0), ",", ring(0.25, 0.5, 1.0, 2.0), "]"))
            .when(F.col("g") == 9, geojson("MultiPoint", "[", point, "]"))
            .when(F.col("g") == 10, geojson("Polygon", "[[", point, ",", point, ",", point, "]]"))
            .otherwise(geojson("Circle", point)))
    return of.select(F.col("g").alias("id"), F.concat(F.lit("USERS_"), F.col("g").cast("string")).alias("name"), text.alias("geojson"))


# --------------------------------------------------------------------------
# citizen report documents

def _q(c: Column) -> Column:
    """JSON string literal of a plain text column (no escaping needed here)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _date_value(event_id: Column, ts: Column) -> Column:
    day = F.date_format(ts, "yyyy-MM-dd")
    k = event_id % 7
    return (F.when(k == 0, _q(day))
            .when(k == 1, _q(F.date_format(ts, "dd/MM/yyyy")))
            .when(k == 2, _q(F.date_format(ts, "yyyy/MM/dd")))
            .when(k == 3, _q(F.concat(day, F.lit("T05:45:27.245775"))))
            .when(k == 4, _q(F.concat(day, F.lit("T05:45:27"))))
            .when(k == 5, (F.lit(1704067200) + event_id).cast("string"))
            .otherwise(F.lit('"not a date"')))


def _doc(event_id: Column, xid: Column, d: Column, t: Column, cu: Column) -> Column:
    ut = F.upper(t)
    fmt = event_id % 9
    j = F.concat
    lit = F.lit
    return (
        F.when(fmt == 0, j(lit('{"event":{"id":'), _q(xid), lit(',"timestamp":'), d, lit(',"payload":{"type":'),
                           _q(ut), lit(',"commune":'), _q(cu), lit(',"quartier":"Q1"}}}')))
        .when(fmt == 1, j(lit('{"request_id":'), _q(xid), lit(',"created_at":'), d, lit(',"type":'), _q(t),
                          lit(',"city":'), _q(cu), lit(',"district":"Q2","status":"open"}')))
        .when(fmt == 2, j(lit('{"id":'), _q(xid), lit(',"date":'), d, lit(',"category":'), _q(t),
                          lit(',"state":"done","geo":"6.5, 1.25"}')))
        .when(fmt == 3, j(lit('{"_id":'), _q(xid), lit(',"date_creation":'), d, lit(',"type_demande":'), _q(ut),
                          lit(',"statut":"new","localisation":{"commune":'), _q(cu), lit(',"quartier":"Q4"}}')))
        .when(fmt == 4, j(lit('{"ref":'), _q(xid), lit(',"date_signalement":'), d, lit(',"service_type":'), _q(t),
                          lit(',"status":"open","localisation":"Q5 - '), cu, lit('"}')))
        .when(fmt == 5, j(lit('{"_id":'), _q(xid), lit(',"event_date":'), d, lit(',"service":'), _q(t),
                          lit(',"location":{"commune":'), _q(cu), lit("}}")))
        .when(fmt == 6, j(lit('{"created":'), d, lit(',"type_demande":'), _q(t), lit("}")))
        .when(fmt == 7, j(lit('{"foo":'), event_id.cast("string"), lit("}")))
        .otherwise(j(lit('{"id":'), _q(xid), lit(',"date":'), d, lit(',"category":'), _q(t),
                     lit(',"state":"done","geo":"bad,geo"}')))
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_key, pos, fmt, xid, doc (JSON text); one document per event."""
    e = dealt(events(spark, sf_dir))
    i = F.col("event_id")
    xid = F.concat(F.lit("REQ-"), ((i % 4000) - (i % 2)).cast("string"))
    cu = F.concat(F.lit("C"), F.col("user_id").cast("string"))
    return e.select(
        F.concat(F.lit("date="), F.date_format("ts", "yyyy-MM-dd")).alias("file_key"),
        i.alias("pos"),
        (i % 9).alias("fmt"),
        xid.alias("xid"),
        _doc(i, xid, _date_value(i, F.col("ts")), F.col("event_type"), cu).alias("doc"),
    )


def docs_chunk(pos: Column, size: int) -> Column:
    """Landing file number of a document inside its day (bounded file size)."""
    return idiv(pos, size)
