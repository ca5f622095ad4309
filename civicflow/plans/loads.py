"""Clean load and raw → spatial jobs.

* ``clean_load``: every clean Parquet file, the validation's and those that
  other writers put beside them (S5) → append to ``raw_events``,
  tagged with the load id.  As in the reference each load rescans the full
  clean history, so ``raw_events`` holds one copy of a row per load.
* ``raw_to_spatial``: ``raw_events`` → one row per id (latest load, then
  latest landing, latest ts, then all columns) → typed spatial rows → upsert by id.  The
  dedupe makes the upsert well defined where the database would reject a
  batch that touches one key twice.

The last row of an id is the one that landed last (``ingest_ds``), and of one
landing the one with the latest ts: a correction re-sent with an earlier ts
wins, in the batch and in the streaming load alike.  Rows without an id are
rejected by the validation and never get here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.spatial_join import read_shapes, rejected_regions
from civicflow.operators.upsert import keep_last, upsert
from civicflow.plans.spatial import to_spatial
from civicflow.schemas import CLEAN_FILE, REGION_SOURCE
from civicflow.sinks import tables
from civicflow.sinks.snapshots import Snapshot
from civicflow.sources import events_files, wkb

EVENT_KEY = ["id"]
# which of several rows of an id is the last
LAST_LANDED = ["ingest_ds", "ts"]
EVENT_REPLACED = ("ts", "geom", "value", "category", "source", "value_double")


def clean_load(spark: SparkSession, clean_root: str, raw_events_path: str, load_id: str,
               with_totals: bool = True) -> DataFrame | None:
    """K3: append the whole clean history to ``raw_events``; returns A7 totals.

    Rows are counted by an observation on the append itself (no second pass
    over the data); files by a metadata-only scan of the file paths, which
    ``with_totals=False`` skips (and then returns None).
    """
    own, foreign = events_files.clean_folders(spark, clean_root)
    parts, files = [], []
    if own or not foreign:
        # beside folders of others, the folders of the validation are named: their levels differ
        clean = (spark.read.schema(CLEAN_FILE).option("basePath", clean_root).parquet(*own) if foreign
                 else events_files.scan_clean(spark, clean_root))
        parts.append(events_files.clean_event_columns(clean))
        files.append(clean.select(F.col("_metadata.file_path").alias("file")))
    if foreign:
        others = events_files.scan_foreign(spark, foreign)
        # the validation rejects rows without an id, other writers may not
        parts.append(others.drop("file").where(F.col("id").isNotNull()))
        files.append(others.select("file"))
    rows = reduce(DataFrame.unionByName, parts).withColumn("load_id", F.lit(load_id))
    obs = Observation(f"load_{load_id}")
    tables.append(rows.observe(obs, F.count(F.lit(1)).alias("rows_loaded")), raw_events_path)
    if not with_totals:
        return None
    n_files = reduce(DataFrame.unionByName, files).distinct().count()
    return spark.range(1).select(F.lit(load_id).alias("load_id"), F.lit(n_files).cast("long").alias("files_loaded"),
                                 F.lit(obs.get["rows_loaded"]).cast("long").alias("rows_loaded"))


def latest_per_id(raw_events: DataFrame) -> DataFrame:
    """One raw row per id: latest load, then latest landing, latest ts, all columns."""
    return keep_last(raw_events, ["id"], ["load_id", *LAST_LANDED])


def raw_to_spatial(raw_events: DataFrame) -> DataFrame:
    """P6 on the deduplicated raw rows."""
    return to_spatial(latest_per_id(raw_events))


def upsert_events(target: DataFrame, batch: DataFrame, unique: bool = False) -> DataFrame:
    """K4: ON CONFLICT (id) DO UPDATE all non-key columns; ``unique``: the batch holds an id once."""
    return upsert(target, batch if unique else keep_last(batch, EVENT_KEY, ["ts"]), EVENT_KEY, EVENT_REPLACED)


def region_source(spark: SparkSession, path: str) -> DataFrame:
    """``(id, name, geojson)`` of JSON lines; a row without GeoJSON has its geometry as well-known binary, in hexadecimal."""
    rows = spark.read.schema(T.StructType([*REGION_SOURCE.fields, T.StructField("wkb", T.StringType())])).json(path)
    plain = rows.where(F.col("wkb").isNull()).select("id", "name", "geojson")
    return plain.unionByName(wkb.with_geojson(rows.where(F.col("wkb").isNotNull()).select("id", "name", "wkb")))


def regions_load(table: Snapshot, source: DataFrame) -> DataFrame:
    """Upsert the regions whose geometry can be used by id; returns (id, name, reasons) of the others.

    A region without an id or a name, with a name that another region has, or
    with an id that the load has twice goes to the table's quarantine.
    """
    rows = read_shapes(source).where(F.size("reasons") == 0).select("id", "name", "geojson")
    table.merge(rows, ["id"], lambda current, batch: upsert(current, batch, ["id"], ["name", "geojson"]))
    return rejected_regions(source)
