"""Incremental daily loads (T1) with Structured Streaming.

The reference rescans the whole clean history every day and appends it
again.  Here file streams pick up only the files they have not seen (the
checkpoint remembers them):

* clean event partitions → each micro-batch upserted by id into the
  day-partitioned spatial events snapshot (K4);
* landed report files → each micro-batch parsed, normalised, deduplicated
  and upserted by external id into the reports snapshot (K5).

``availableNow`` processes what has landed and stops, so a job runs on a
schedule like a batch job but never rereads old files.  A version records the
stream and epoch that made it: an epoch played again, because the process died
between the table's commit and the checkpoint's, makes no version.
"""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators.upsert import keep_last
from civicflow.plans import reports
from civicflow.plans.loads import EVENT_KEY, LAST_LANDED, upsert_events
from civicflow.plans.spatial import to_spatial
from civicflow.schemas import CITIZEN_REPORTS, CLEAN_FILE, SPATIAL_EVENTS
from civicflow.sinks.snapshots import Snapshot
from civicflow.sinks.tables import hadoop_fs
from civicflow.sources import json_reports


def events_table(spark: SparkSession, path: str) -> Snapshot:
    """The spatial events snapshot, partitioned by event day so that
    time-window queries read only the days they need."""
    return Snapshot(spark, path, SPATIAL_EVENTS, partitions={"date": lambda: F.to_date("ts")})


def reports_table(spark: SparkSession, path: str) -> Snapshot:
    """The reports snapshot, in buckets of the external id: a batch rewrites those that hold its reports."""
    return Snapshot(spark, path, CITIZEN_REPORTS, buckets=reports.REPORT_KEY)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint; another one if the checkpoint is made anew."""
    fs, path, jvm = hadoop_fs(spark, f"{checkpoint.rstrip('/')}/metadata")
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
    text = lines.readLine()
    lines.close()
    return json.loads(text)["id"]


def _apply_batch(table: Snapshot, checkpoint: str):
    def apply(batch: DataFrame, epoch_id: int) -> None:
        # one row per id by the same rule as the batch load
        rows = to_spatial(keep_last(batch.drop("date"), ["id"], LAST_LANDED))
        table.merge(rows, EVENT_KEY, partial(upsert_events, unique=True), (query_id(table.spark, checkpoint), epoch_id))
    return apply


def run_available(spark: SparkSession, clean_root: str, table_path: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> None:
    """Process every clean file that landed since the last run, then stop."""
    reader = spark.readStream.schema(CLEAN_FILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(clean_root).where(F.col("id").isNotNull())
    query = (stream.writeStream
             .foreachBatch(_apply_batch(events_table(spark, table_path), checkpoint))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _apply_reports(table: Snapshot, run_ts, checkpoint: str):
    def apply(batch: DataFrame, epoch_id: int) -> None:
        docs = json_reports.documents_of(batch).select(F.col("file_path").alias("file_key"), "pos", "doc")
        rows = reports.to_table_rows(reports.dedupe(reports.normalize(docs)))
        table.merge(rows, reports.REPORT_KEY, partial(reports.upsert_reports, ingested_at=run_ts),
                    (query_id(table.spark, checkpoint), epoch_id))
    return apply


def run_reports_available(spark: SparkSession, reports_root: str, table_path: str, checkpoint: str,
                          run_ts: str, max_files_per_trigger: int | None = None, glob: str | None = None) -> None:
    """K5 incrementally: report files that landed since the last run are
    parsed, normalised, deduplicated and upserted, one micro-batch at a time
    (files in arrival order, so a later file still wins)."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.text(reports_root, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), "value")
    table = reports_table(spark, table_path)
    stamp = F.lit(run_ts).cast("timestamp_ntz")
    query = (files.writeStream.foreachBatch(_apply_reports(table, stamp, checkpoint))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
