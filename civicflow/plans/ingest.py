"""Validate + partition job and its run metrics.

A batch may hold one landing day (the reference's daily run) or many; each
landing day ``ds`` is one run.  The checked batch is written once to the
shared folder and feeds the clean write, the reject write and the per-run
counters, so the bronze input is parsed once and a lost executor costs a
read, not a parse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators import validate as V
from civicflow.operators.rollup import Rollup
from civicflow.operators.upsert import upsert
from civicflow.schemas import PIPELINE_METRICS
from civicflow.session import scratch
from civicflow.sinks import tables
from civicflow.sinks.snapshots import Snapshot

# Job and table names recorded in the metrics table.
DAG_ID = "validate_and_partition_events"
TABLE_TARGET = "events"
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED = "FAILED"
# columns an existing run row takes from a retry; the rest are kept
METRICS_KEY = ["run_id", "table_target"]
METRICS_REPLACED = ("rows_read", "rows_written", "bad_records_count", "status", "finished_at")


def run_id_of(ds: Column) -> Column:
    """Scheduler-style run id of a landing day."""
    return F.concat(F.lit("scheduled__"), F.date_format(ds, "yyyy-MM-dd"), F.lit("T00:00:00+00:00"))


def run_metrics(checked: DataFrame, days: list[str] | None = None) -> DataFrame:
    """A5/A6 per run (landing day): counters, error rate, 5 % flag.

    With ``days`` there is a row for each of them, with counters 0 when the
    day has no rows.
    """
    per_run = checked.groupBy("ds").agg(*V.run_counters(checked))
    if days is not None:
        runs = checked.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(d) for d in days]).cast("array<date>")).alias("ds"))
        counters = [c for c in per_run.columns if c != "ds"]
        per_run = runs.join(per_run, "ds", "left").select("ds", *[F.coalesce(c, F.lit(0)).alias(c) for c in counters])
    return V.with_error_rate(per_run).select(
        F.lit(DAG_ID).alias("dag_id"), run_id_of(F.col("ds")).alias("run_id"),
        F.lit(TABLE_TARGET).alias("table_target"),
        F.col("ds").cast("timestamp_ntz").alias("execution_date"),
        "rows_read", "rows_written", "bad_records_count", "rows_unpartitioned",
        "error_rate", "error_pct", "high_error", F.lit(STATUS_SUCCESS).alias("status"))


def clean_rows(checked: DataFrame) -> DataFrame:
    """Rows to write, with their partition columns ``date, category, ingest_ds``.

    ``ingest_ds`` (the landing day) is the first partition level, so a rerun
    of one landing day replaces its whole folder and never a file that
    another landing day wrote for the same event date.
    """
    return (V.partition_keys(checked)
            .select(F.col("id").cast("string").alias("id"), F.col("_ts").alias("ts"),
                    F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude"),
                    F.col("_value").alias("value"), F.col("source").cast("string").alias("source"),
                    "date", F.col("category").cast("string").alias("category"),
                    F.date_format("ds", "yyyy-MM-dd").alias("ingest_ds")))


def reject_rows(checked: DataFrame) -> DataFrame:
    """K7 rows of every run, with the ``run_date`` partition column."""
    return V.rejects(checked, run_id_of(F.col("ds")),
                     extra=[F.date_format("ds", "yyyy-MM-dd").alias("run_date")])


@dataclass
class IngestResult:
    metrics: DataFrame | None  # one row per run (None if not asked for)
    clean_path: str
    rejects_path: str


def validate_and_partition(spark: SparkSession, raw: DataFrame, clean_path: str, rejects_path: str,
                           with_metrics: bool = True, days: list[str] | None = None) -> IngestResult:
    """Check a bronze batch, write clean partitions and rejects, count per run.

    ``raw`` carries the bronze columns plus ``ds`` (landing day).  ``days``
    are the landing days that the batch replaces, those of its rows unless
    given: clean rows, rejects and metrics of a day always come from its
    last run alone, also when that has fewer rows or none.  A caller that
    does not use the per-run counters passes ``with_metrics=False``.
    """
    folder = scratch(spark, "checked")
    V.check(raw).write.parquet(folder)
    checked = spark.read.parquet(folder)
    if days is None:
        # one short text for each landing day
        days = [r["d"] for r in checked.select(F.date_format("ds", "yyyy-MM-dd").alias("d")).distinct().collect() if r["d"]]
    tables.replace_days(clean_rows(checked), clean_path, days, ["ingest_ds", "date", "category"])
    tables.replace_days(reject_rows(checked), rejects_path, days, ["run_date"])
    metrics = run_metrics(checked, days) if with_metrics else None
    return IngestResult(metrics, clean_path, rejects_path)


def failed_run(spark: SparkSession, ds: str, error: str, finished_at: Column) -> DataFrame:
    """The metrics row of a run that failed: nothing counted, the error text kept."""
    none = F.lit(0).cast("long")
    return spark.range(1).select(
        F.lit(DAG_ID).alias("dag_id"), run_id_of(F.lit(ds).cast("date")).alias("run_id"), F.lit(TABLE_TARGET).alias("table_target"),
        F.lit(ds).cast("date").cast("timestamp_ntz").alias("execution_date"), none.alias("rows_read"), none.alias("rows_written"),
        none.alias("bad_records_count"), F.lit(STATUS_FAILED).alias("status"), F.lit(error).alias("error_message"),
        finished_at.alias("finished_at"))


def metrics_rows(metrics: DataFrame, status: Column, error_message: Column, finished_at: Column,
                 rows_written: Column | None = None) -> DataFrame:
    """Metrics-table rows (the INSERT column list) from per-run counters."""
    return metrics.select(
        "dag_id", "run_id", "table_target", "execution_date", "rows_read",
        (rows_written if rows_written is not None else F.col("rows_written")).cast("long").alias("rows_written"),
        "bad_records_count", status.alias("status"), error_message.cast("string").alias("error_message"),
        finished_at.alias("finished_at"))


def upsert_metrics(target: DataFrame, batch: DataFrame, refresh_error: bool = False) -> DataFrame:
    """K6: conflict on (run_id, table_target); counters, status and
    finished_at are replaced; error_message, execution_date and started_at
    are kept.  A new row's started_at defaults to its insert time.

    As in the reference, a successful retry keeps the failed attempt's
    error_message; ``refresh_error=True`` replaces it too.
    """
    replaced = METRICS_REPLACED + (("error_message",) if refresh_error else ())
    return upsert(target, batch, METRICS_KEY, replaced, insert_defaults={"started_at": F.col("b.finished_at")})


def health_sums(metrics: Snapshot, path: str) -> Rollup:
    """A8's sums by (day, status), kept current with the metrics table."""
    counters = ("rows_read", "rows_written", "bad_records_count")
    return Rollup(metrics, path, {"day": (T.DateType(), lambda: F.to_date("execution_date")), "status": (T.StringType(), lambda: F.col("status"))},
                  {c: (T.LongType(), lambda c=c: F.col(c)) for c in counters})


def metrics_daily_maintained(rollup: Rollup) -> DataFrame:
    """A8 from maintained sums."""
    return rollup.read().select("day", "status", F.col("rows").alias("runs"), *rollup.measures).orderBy(F.col("day").desc(), "status")


def metrics_daily(metrics_table: DataFrame) -> DataFrame:
    """Run health per day and status."""
    return (metrics_table.groupBy(F.to_date("execution_date").alias("day"), "status")
            .agg(F.count(F.lit(1)).alias("runs"), F.sum("rows_read").alias("rows_read"),
                 F.sum("rows_written").alias("rows_written"),
                 F.sum("bad_records_count").alias("bad_records_count"))
            .orderBy(F.col("day").desc(), "status"))


__all__ = ["validate_and_partition", "run_metrics", "clean_rows", "upsert_metrics", "metrics_daily",
           "metrics_rows", "PIPELINE_METRICS"]
