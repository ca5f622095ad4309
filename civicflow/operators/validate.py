"""Bronze event validation: typed columns, check flags, reasons.

One projection adds everything; the valid/bad split and the partition keys
are filters on its columns, so a batch is checked in a single pass with
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.functions import quality as Q
from civicflow.functions.common import to_double


def _parsed_ts(raw: DataFrame):
    field = raw.schema["ts"]
    if isinstance(field.dataType, T.StringType):
        text = F.col("ts")
        parsed = F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")))
        return parsed.cast("timestamp_ntz"), Q.timestamp_ok(text, parsed)
    return F.col("ts").cast("timestamp_ntz"), None


def check(raw: DataFrame) -> DataFrame:
    """Adds ``lat_ok, lon_ok, value_ok, reasons, is_valid`` and typed columns.

    ``raw`` has the bronze columns (id, ts, latitude, longitude, value,
    category, source), as text or typed.  Timestamp text that does not parse
    is a reject reason here (the reference aborts the whole run instead), and
    so is a missing id: rows without one cannot be upserted.
    """
    ts, ts_ok = _parsed_ts(raw)
    lat_ok = Q.latitude_ok(F.col("latitude"))
    lon_ok = Q.longitude_ok(F.col("longitude"))
    val_ok = Q.value_ok(F.col("value"))
    id_ok = F.col("id").isNotNull() if "id" in raw.columns else None
    checked = raw.select(
        "*",
        ts.alias("_ts"),
        to_double(F.col("latitude")).alias("_lat"),
        to_double(F.col("longitude")).alias("_lon"),
        to_double(F.col("value")).alias("_value"),
        lat_ok.alias("lat_ok"), lon_ok.alias("lon_ok"), val_ok.alias("value_ok"),
        Q.reasons(lat_ok, lon_ok, val_ok, ts_ok, id_ok).alias("reasons"),
    )
    return checked.withColumn("is_valid", F.size("reasons") == 0)


def clean_columns() -> list:
    """Typed clean-event columns of a checked frame."""
    return [F.col("id").cast("string").alias("id"), F.col("_ts").alias("ts"), F.col("_lat").alias("latitude"),
            F.col("_lon").alias("longitude"), F.col("_value").alias("value"), F.col("category").cast("string"),
            F.col("source").cast("string")]


def valid(checked: DataFrame) -> DataFrame:
    return checked.where("is_valid").select(*clean_columns())


def partition_keys(checked: DataFrame) -> DataFrame:
    """Valid rows with a day and a category: the rows that are written (A4).

    Rows without either are valid but have no partition; they are counted
    apart (``rows_unpartitioned``), never silently lost from the metrics.
    """
    return (checked.where("is_valid")
            .withColumn("date", F.date_format("_ts", "yyyy-MM-dd"))
            .where(F.col("date").isNotNull() & F.col("category").isNotNull()))


def rejects(checked: DataFrame, run_id, extra: list | tuple = ()) -> DataFrame:
    """K7: one row per bad record with its reasons and the log line."""
    reason = Q.reason_text(F.col("reasons"))
    rid = F.col("id").cast("string") if "id" in checked.columns else F.lit(None).cast("string")
    return (checked.where(~F.col("is_valid"))
            .select(run_id.alias("run_id"), rid.alias("id"), reason.alias("reasons"),
                    Q.reject_message(run_id, rid, reason).alias("message"), *extra))


def run_counters(checked: DataFrame) -> list:
    """A5 aggregate expressions: read, written, bad, unpartitioned."""
    keyed = F.col("_ts").isNotNull() & F.col("category").isNotNull()
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("is_valid") & keyed).alias("rows_written"),
        F.count_if(~F.col("is_valid")).alias("bad_records_count"),
        F.count_if(F.col("is_valid") & ~keyed).alias("rows_unpartitioned"),
    ]


def with_error_rate(metrics: DataFrame) -> DataFrame:
    """Error rate, percent text and the 5 % flag (status stays SUCCESS)."""
    read, bad = F.col("rows_read"), F.col("bad_records_count")
    rate = F.when(read > 0, bad / read)
    return metrics.select(
        "*",
        rate.alias("error_rate"),
        Q.error_pct_text(bad, read).alias("error_pct"),
        F.coalesce(rate > Q.ERROR_RATE_THRESHOLD, F.lit(False)).alias("high_error"))
