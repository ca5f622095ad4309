"""The daily jobs over a lake folder, as a scheduler would run them.

Lake layout (all under one root on shared storage)::

    raw/<source>/date=<ds>/…                       bronze landing (land)
    clean/events/ingest_ds=/date=/category=/       clean events (validate)
    rejects/run_date=/                             reject rows (validate)
    tables/raw_events/                             append table (load_clean)
    tables/events/                                 spatial events snapshot by day (to_spatial, stream_events)
    tables/citizen_reports/                        reports snapshot (citizen_reports)
    tables/pipeline_metrics/                       run metrics snapshot (validate)
    _checkpoints/…                                 streaming checkpoints

Each job is independent and idempotent for its day, like the reference's
daily runs.  Run one from the command line::

    python -m civicflow.plans.jobs validate --lake /lake --ds 2024-01-05
"""

from __future__ import annotations

import argparse
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import session
from civicflow.operators.spatial_join import region_table
from civicflow.plans import analytics, ingest, loads, reports
from civicflow.schemas import PIPELINE_METRICS, REGION_SOURCE
from civicflow.sinks import landing
from civicflow.sinks.snapshots import Snapshot
from civicflow.sinks.tables import hadoop_fs
from civicflow.sources import events_files, json_reports, ranges
from civicflow.streaming import incremental

EVENTS_SOURCE = "events"
REPORTS_SOURCE = "demandes_services"
# only files of this name are reports
REPORTS_GLOB = "*.json"


def _p(lake: str, *parts: str) -> str:
    return "/".join([lake.rstrip("/"), *parts])


def metrics_table(spark: SparkSession, lake: str) -> Snapshot:
    return Snapshot(spark, _p(lake, "tables", "pipeline_metrics"), PIPELINE_METRICS, buckets=ingest.METRICS_KEY)


def events_table(spark: SparkSession, lake: str) -> Snapshot:
    return incremental.events_table(spark, _p(lake, "tables", "events"))


def reports_table(spark: SparkSession, lake: str) -> Snapshot:
    return incremental.reports_table(spark, _p(lake, "tables", "citizen_reports"))


def land(spark: SparkSession, lake: str, config_path: str, ds: str) -> list[str]:
    """Bronze landing of every configured source for day ``ds``."""
    return landing.land_all(spark, config_path, _p(lake, "raw"), ds)


def validate(spark: SparkSession, lake: str, ds: str, finished_at: str | None = None) -> DataFrame:
    """Validate + partition the events landed on ``ds``; upsert the run metrics.

    Reads that day's folder only.  A day without a landed file fails; a file
    without rows is a run with 0 rows.  A run that fails is recorded as
    FAILED with the error text, and the error is raised.  Returns the run's
    metrics row (A5/A6).
    """
    done = F.lit(finished_at or datetime.now().isoformat(sep=" ")).cast("timestamp_ntz")
    table = metrics_table(spark, lake)
    source = _p(lake, "raw", EVENTS_SOURCE)
    try:
        fs, folder, _ = hadoop_fs(spark, f"{source}/date={ds}")
        if not fs.exists(folder) or ranges.listing(spark, f"{source}/date={ds}").filter("length > 0").isEmpty():
            raise FileNotFoundError(f"no CSV landed for {ds}: {source}/date={ds}")
        raw = events_files.scan_csv(spark, source, ds)
        result = ingest.validate_and_partition(spark, raw, _p(lake, "clean", "events"), _p(lake, "rejects"), days=[ds])
        rows = ingest.metrics_rows(result.metrics, F.lit(ingest.STATUS_SUCCESS), F.lit(None), done)
        table.merge(rows, ingest.METRICS_KEY, ingest.upsert_metrics)
    except Exception as e:
        table.merge(ingest.failed_run(spark, ds, str(e), done), ingest.METRICS_KEY, partial(ingest.upsert_metrics, refresh_error=True))
        raise
    return result.metrics


def load_clean(spark: SparkSession, lake: str, load_id: str) -> DataFrame:
    """Append the whole clean history to raw_events (A7 totals returned)."""
    return loads.clean_load(spark, _p(lake, "clean", "events"), _p(lake, "tables", "raw_events"), load_id)


def to_spatial(spark: SparkSession, lake: str) -> int:
    """raw_events → one typed row per id → upsert into the events snapshot."""
    table = events_table(spark, lake)
    batch = loads.raw_to_spatial(spark.read.parquet(_p(lake, "tables", "raw_events")))
    return table.merge(batch, loads.EVENT_KEY, partial(loads.upsert_events, unique=True))


def stream_events(spark: SparkSession, lake: str) -> None:
    """The incremental alternative to load_clean + to_spatial."""
    incremental.run_available(spark, _p(lake, "clean", "events"), _p(lake, "tables", "events"),
                              _p(lake, "_checkpoints", "events_load"))


def stream_reports(spark: SparkSession, lake: str, run_ts: str | None = None) -> None:
    """T1 for reports: the incremental alternative to citizen_reports."""
    incremental.run_reports_available(spark, _p(lake, "raw", REPORTS_SOURCE), _p(lake, "tables", "citizen_reports"),
                                      _p(lake, "_checkpoints", "reports_load"),
                                      run_ts or datetime.now().isoformat(sep=" "), glob=REPORTS_GLOB)


def citizen_reports(spark: SparkSession, lake: str, run_ts: str | None = None) -> DataFrame:
    """All landed report files → normalise → last per id → upsert.

    Returns the run totals as ``(metric, value)`` rows: documents,
    reports_processed, files, quarantined_files.
    """
    prefix = _p(lake, "raw", REPORTS_SOURCE)
    # parsed and normalised once: the upsert and all totals read the written rows
    folder = session.scratch(spark, "reports")
    reports.normalize(json_reports.scan(spark, prefix, REPORTS_GLOB).select(F.col("file_path").alias("file_key"), "pos", "doc")
                      ).write.parquet(folder)
    docs = spark.read.parquet(folder)
    batch = reports.to_table_rows(reports.dedupe(docs))
    table = reports_table(spark, lake)
    stamp = F.lit(run_ts or datetime.now().isoformat(sep=" ")).cast("timestamp_ntz")
    table.merge(batch, reports.REPORT_KEY, partial(reports.upsert_reports, ingested_at=stamp))

    def total(name: str, df: DataFrame, value) -> DataFrame:
        return df.agg(value.cast("long").alias("value")).select(F.lit(name).alias("metric"), "value")

    return (total("documents", docs, F.count(F.lit(1)))
            .unionByName(total("reports_processed", reports.processed_per_file(docs), F.coalesce(F.sum("reports"), F.lit(0))))
            .unionByName(total("files", docs, F.count_distinct("file_key")))
            .unionByName(total("quarantined_files", json_reports.quarantine(spark, prefix, REPORTS_GLOB), F.count(F.lit(1)))))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions from JSON lines ``{"id":…, "name":…, "geojson":…}``, or ``"wkb"`` in hexadecimal instead of the last."""
    return region_table(loads.region_source(spark, path))


def regions_table(spark: SparkSession, lake: str) -> Snapshot:
    """Regions by id, their names unique."""
    return Snapshot(spark, _p(lake, "tables", "regions"), REGION_SOURCE, buckets=["id"], unique=[["name"]])


def load_regions(spark: SparkSession, lake: str, path: str) -> DataFrame:
    """Upsert regions whose geometry can be used; returns (id, name, reasons) of the others."""
    return loads.regions_load(regions_table(spark, lake), loads.region_source(spark, path))


def analytics_report(spark: SparkSession, lake: str, regions_path: str, as_of: str) -> dict[str, DataFrame]:
    """The three analytical queries over the current events snapshot."""
    events = events_table(spark, lake).read()
    return {
        "daily_avg": analytics.daily_avg(events, as_of),
        "events_per_region": analytics.events_per_region(events, read_regions(spark, regions_path), as_of),
        "hotspots_top5": analytics.hotspots(events, as_of),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="civicflow.plans.jobs")
    parser.add_argument("job", choices=["land", "validate", "load_clean", "to_spatial", "stream_events", "load_regions",
                                        "citizen_reports", "stream_reports", "analytics"])
    parser.add_argument("--lake", required=True)
    parser.add_argument("--ds")
    parser.add_argument("--config")
    parser.add_argument("--load-id")
    parser.add_argument("--regions")
    parser.add_argument("--as-of")
    args = parser.parse_args(argv)
    spark = session.configure(SparkSession.builder.getOrCreate())
    if args.job == "land":
        land(spark, args.lake, args.config, args.ds)
    elif args.job == "validate":
        validate(spark, args.lake, args.ds).show(truncate=False)
    elif args.job == "load_clean":
        load_clean(spark, args.lake, args.load_id or datetime.now().isoformat()).show(truncate=False)
    elif args.job == "to_spatial":
        to_spatial(spark, args.lake)
    elif args.job == "stream_events":
        stream_events(spark, args.lake)
    elif args.job == "citizen_reports":
        citizen_reports(spark, args.lake).show(truncate=False)
    elif args.job == "load_regions":
        load_regions(spark, args.lake, args.regions).show(truncate=False)
    elif args.job == "stream_reports":
        stream_reports(spark, args.lake)
    else:
        for name, df in analytics_report(spark, args.lake, args.regions, args.as_of).items():
            print(name)
            df.show(truncate=False)


if __name__ == "__main__":
    main()
