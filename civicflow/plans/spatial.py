"""raw events → spatial events table (P6 + F3/F4/F20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.functions.geo import SRID_METADATA, make_point
from civicflow.schemas import VALUE_DECIMAL


def to_spatial(raw: DataFrame) -> DataFrame:
    """``id::BIGINT, ts AT TIME ZONE 'UTC', point(lon, lat), value::NUMERIC``.

    The id cast is an ANSI cast: text that is not a number raises, as the
    database cast does.  A value that the decimal cannot hold (infinity, more
    than 28 digits) is NULL there and whole in ``value_double``, so one such
    row never stops a load.  Timestamps are already UTC wall clock, so the
    zone conversion is the identity on ``timestamp_ntz``.
    """
    return raw.select(
        F.col("id").cast("long").alias("id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        make_point(F.col("longitude"), F.col("latitude")).alias("geom", metadata=SRID_METADATA),
        F.col("value").try_cast(VALUE_DECIMAL).alias("value"),
        "category",
        "source",
        F.col("value").cast("double").alias("value_double"),
    )
