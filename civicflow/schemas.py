"""Table schemas (the DDL of the reference, in Spark types).

Timestamps are UTC wall-clock ``timestamp_ntz`` throughout: the engine pins
the session zone to UTC, so this is the TIMESTAMPTZ of the reference with
the zone fixed, and it never shifts when a session runs in another zone.
"""

from pyspark.sql import types as T

from civicflow.functions.geo import SRID_METADATA

POINT = T.StructType([
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
])

# numeric(…) of the spatial events table; scale 10 keeps doubles with a
# short decimal text exact (0.1D+0.2D at scale 18 would show binary noise)
VALUE_DECIMAL = T.DecimalType(38, 10)

# bronze CSV: every field is read as text, typed later with try_cast
RAW_CSV = T.StructType([T.StructField(c, T.StringType()) for c in
                        ("id", "timestamp", "latitude", "longitude", "value", "category", "source")])

# clean events (silver files) and the raw_events table
CLEAN_EVENTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("source", T.StringType()),
])

# clean files: data columns, then the partition directories
CLEAN_FILE = T.StructType([f for f in CLEAN_EVENTS.fields if f.name != "category"] + [
    T.StructField("date", T.DateType()),
    T.StructField("category", T.StringType()),
    T.StructField("ingest_ds", T.DateType()),
])

# spatial events table: id is the key
SPATIAL_EVENTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("geom", POINT, metadata=SRID_METADATA),
    T.StructField("value", VALUE_DECIMAL),
    T.StructField("category", T.StringType()),
    T.StructField("source", T.StringType()),
    # the value as read: infinity and numbers beyond the decimal's range stay whole here
    T.StructField("value_double", T.DoubleType()),
])

PIPELINE_METRICS = T.StructType([
    T.StructField("dag_id", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("table_target", T.StringType(), False),
    T.StructField("execution_date", T.TimestampNTZType(), False),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("bad_records_count", T.LongType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
])

CITIZEN_REPORTS = T.StructType([
    T.StructField("external_id", T.StringType(), False),
    T.StructField("source_timestamp", T.TimestampNTZType()),
    T.StructField("category", T.StringType()),
    T.StructField("commune", T.StringType()),
    T.StructField("quartier", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("geom", POINT, metadata=SRID_METADATA),
    T.StructField("original_doc", T.VariantType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
])

REGION_SOURCE = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("geojson", T.StringType()),
])
