"""The daily jobs end to end on a lake folder, two landing days."""

from pyspark.sql import functions as F

from civicflow import catalog
from civicflow.plans import jobs
from civicflow.sinks import landing
from civicflow.sources import events_files, fixtures

from conftest import SMALL

DAYS = ("2024-01-16", "2024-02-01")


def _landing_rows(ds):
    split = F.lit("2024-01-16").cast("date")
    return F.col("ds") < split if ds == DAYS[0] else F.col("ds") >= split


def _export(spark, root, ds, cond):
    raw = fixtures.raw_ev(spark, SMALL).where(cond)
    events_files.write_csv_export(raw, f"{root}/exports/{ds}/events.csv")
    day = F.col("date") < "2024-01-16" if ds == "2024-01-16" else F.col("date") >= "2024-01-16"
    docs = (fixtures.docs(spark, SMALL).select(F.substring("file_key", 6, 10).alias("date"), "pos", "doc")
            .where(day))
    landing.write_json_lists(docs, f"{root}/exports/{ds}/demandes_services.json")
    cfg = F.to_json(F.array(
        F.struct(F.lit("events").alias("name"), F.lit(f"{root}/exports/{ds}/events.csv").alias("path")),
        F.struct(F.lit("Demandes Services").alias("name"),
                 F.lit(f"{root}/exports/{ds}/demandes_services.json").alias("path"))))
    spark.range(1).select(cfg.alias("value")).coalesce(1).write.text(f"{root}/config/{ds}")
    return f"{root}/config/{ds}"


def test_daily_pipeline(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    lake2 = f"{tmp_dir}/lake_stream"
    totals = []
    for i, ds in enumerate(DAYS):
        config = _export(spark, tmp_dir, ds, _landing_rows(ds))
        for target in (lake, lake2):
            jobs.land(spark, target, config, ds)
            jobs.validate(spark, target, ds, finished_at=f"{ds} 02:00:00")
        jobs.load_clean(spark, lake, f"L{i}")
        jobs.to_spatial(spark, lake)
        jobs.stream_events(spark, lake2)
        jobs.stream_reports(spark, lake2, f"{ds} 03:00:00")
        totals.append({r["metric"]: r["value"] for r in jobs.citizen_reports(spark, lake, f"{ds} 03:00:00").collect()})

    metrics = jobs.metrics_table(spark, lake).read()
    m = metrics.agg(F.count(F.lit(1)), F.sum("rows_read"), F.sum("rows_written")).first()
    assert m[0] == 2 and m[1] == fixtures.events(spark, SMALL).count()
    events = jobs.events_table(spark, lake).read()
    assert events.count() == m[2]
    # batch and streaming loads build the same table
    streamed = jobs.events_table(spark, lake2).read()
    assert sorted(map(tuple, events.collect())) == sorted(map(tuple, streamed.collect()))
    # reports: same table as the registered query computes
    table = jobs.reports_table(spark, lake).read()
    want = catalog.reports_table(spark, SMALL)
    cols = ["external_id", "category", "commune", "quartier", "status"]
    assert sorted(map(tuple, table.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # the streaming reports load builds the same table, ingested_at included
    streamed_reports = jobs.reports_table(spark, lake2).read()
    cols2 = cols + ["source_timestamp", "ingested_at"]
    assert sorted(map(tuple, streamed_reports.select(cols2).collect())) == \
        sorted(map(tuple, table.select(cols2).collect()))
    assert totals[0]["quarantined_files"] == 0 and totals[1]["documents"] > 0
    # analytics over the lake
    spark.createDataFrame(fixtures.region_source(spark).collect()).write.json(f"{tmp_dir}/regions")
    out = jobs.analytics_report(spark, lake, f"{tmp_dir}/regions", fixtures.AS_OF)
    assert out["hotspots_top5"].count() == 5
    assert {r[0] for r in out["events_per_region"].collect()} <= {"RECT_SOUTH", "RECT_OVERLAP", "EMPTY", "OLD_ONLY"}
