"""Plan shape checks: pushdown, no Python in the hot path, bounded top-k."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

from conftest import SMALL

LAZY = ["daily_avg", "hotspots_top5", "events_per_region", "validate_events", "run_metrics", "reports_normalize",
        "reports_dedupe", "reports_upsert", "metrics_upsert", "constraint_checks"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_udf_and_no_nested_loop(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert node not in plan


def test_hotspots_is_a_bounded_top_k(spark):
    df = entry.queries()["hotspots_top5"](spark, SMALL)
    assert "TakeOrderedAndProject" in _plan(df)


def test_time_window_reaches_the_scan(spark):
    df = entry.queries()["daily_avg"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    # only the columns the query needs are read
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_spread_only_touches_few_split_scans(spark):
    from civicflow.operators.parallel import input_partitions, spread
    scan = spark.read.parquet(f"{SMALL}/events.parquet")
    assert input_partitions(scan) == 1
    assert "RoundRobinPartitioning" in _plan(spread(scan))
    agg = scan.groupBy("event_type").count()
    assert input_partitions(agg) is None and spread(agg) is agg
    wide = spark.range(0, 100, 1, 16)
    assert spread(wide, 8) is wide
    # more than a quarter of the cores busy: no shuffle of the whole input
    assert spread(wide, 63) is wide and spread(wide, 64) is not wide


def test_spread_is_not_led_by_names(spark, tmp_dir):
    from civicflow.operators.parallel import input_partitions
    spark.range(10).selectExpr("id AS SortJoinExchange").coalesce(1).write.parquet(f"{tmp_dir}/JoinedTables")
    assert input_partitions(spark.read.parquet(f"{tmp_dir}/JoinedTables")) == 1


def test_quiet_regions_far_apart_read_their_own_boxes(spark, tmp_dir):
    """Two regions with old events only, in opposite corners: the scan of old events gets both boxes, not one around them."""
    from datetime import datetime

    from civicflow.functions import geo
    from civicflow.operators.spatial_join import region_table
    from civicflow.plans import analytics
    rows = [(i, datetime(2023, 1, 1), (0.5 if i % 2 else 50.5), (0.5 if i % 2 else 50.5)) for i in range(50)]
    rows += [(100 + i, datetime(2023, 1, 1), 25.0, 25.0) for i in range(50)]
    spark.createDataFrame(rows, "id long, ts timestamp_ntz, lon double, lat double").select(
        "id", "ts", geo.make_point(F.col("lon"), F.col("lat")).alias("geom")).write.parquet(f"{tmp_dir}/events")
    regions = region_table(spark.createDataFrame(
        [(k, f"r{k}", '{"type":"Polygon","coordinates":[[[%d,%d],[%d,%d],[%d,%d],[%d,%d],[%d,%d]]]}' % (x, x, x + 1, x, x + 1, x + 1, x, x + 1, x, x))
         for k, x in ((1, 0), (2, 50))], "id int, name string, geojson string"))
    out = analytics.events_per_region(spark.read.parquet(f"{tmp_dir}/events"), regions, "2024-02-01 00:00:00")
    plan = _plan(out)
    assert "Or(And(And(GreaterThanOrEqual(geom.lon," in plan  # in PushedFilters, whose text is cut after it
    assert "geom#" in plan and "lon <= 1.0)" in plan and "lon >= 50.0)" in plan
    assert out.collect() == []  # only old events


def test_a_hot_region_is_split(spark):
    """Nine tenths of the boundary points in one region: the join with the shuffled outlines is split."""
    from civicflow.operators.spatial_join import region_table, within_join
    box = '{"type":"Polygon","coordinates":[[[%d,0],[%d,0],[%d,1],[%d,1],[%d,0]]]}'
    regions = region_table(spark.createDataFrame([(k, f"r{k}", box % (k, k + 1, k + 1, k, k)) for k in range(8)],
                                                 "id int, name string, geojson string"))
    points = spark.range(200_000).selectExpr("IF(id % 10 > 0, 0.0, double(id div 10 % 8)) + rand(1) AS lon", "rand(2) AS lat")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        counted = within_join(points, regions, max_cells=4, broadcast_max_edges=0, broadcast_max_cells=0).groupBy("region_id").count()
        assert counted.count() == 8
        counted.collect()
        plan = _plan(counted)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    joins = [line for line in plan.splitlines() if "skew=true" in line]
    assert any("region_id" in line for line in joins), joins


def test_window_prunes_day_partitions_of_the_events_snapshot(spark, tmp_dir):
    from civicflow import catalog
    from civicflow.plans import analytics
    from civicflow.streaming.incremental import events_table
    table = events_table(spark, f"{tmp_dir}/events")
    table.commit(catalog.spatial_events(spark, SMALL))
    events = table.read()
    for df in (analytics.daily_avg(events, catalog.AS_OF), analytics.hotspots(events, catalog.AS_OF)):
        plan = _plan(df)
        assert "PartitionFilters: [isnotnull(date" in plan and "(date#" in plan
    # same answers as over the unpartitioned source
    want = sorted(map(tuple, analytics.daily_avg(catalog.spatial_events(spark, SMALL), catalog.AS_OF).collect()))
    assert sorted(map(tuple, analytics.daily_avg(events, catalog.AS_OF).collect())) == want


def test_daily_avg_of_only_null_values_is_null(spark):
    from civicflow.plans import analytics
    from civicflow.schemas import SPATIAL_EVENTS
    rows = [(1, __import__("datetime").datetime(2024, 1, 30), None, None, "a", "s", None)]
    df = spark.createDataFrame(rows, SPATIAL_EVENTS)
    got = analytics.daily_avg(df, "2024-02-01 00:00:00").collect()
    assert len(got) == 1 and got[0]["avg_value"] is None


@pytest.mark.parametrize("name,partial", [("reports_dedupe", "partial_max_by"), ("hotspots_top5", "partial_sum"),
                                          ("reports_per_region", "partial_count"), ("daily_avg", "partial_sum"),
                                          ("constraint_checks", "partial_count")])
def test_hot_keys_are_pre_aggregated_before_the_shuffle(spark, name, partial):
    plan = _plan(entry.queries()[name](spark, SMALL))
    assert partial in plan


def test_tables_of_one_row_group_are_dealt(spark, tmp_dir):
    """A file with one row group has many splits and rows in one of them; its documents are built by all tasks, each with its share."""
    from pyspark.sql import functions as F

    from civicflow.sources import fixtures
    fixtures.events(spark, SMALL).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        for df in (fixtures.docs(spark, tmp_dir), fixtures.raw_ev(spark, tmp_dir)):
            counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert len(counts) >= 4 and max(counts) <= 500 and sum(counts) == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_large_table_is_dealt_by_its_size(spark, monkeypatch):
    from civicflow.operators import parallel
    scan = spark.read.parquet(f"{SMALL}/events.parquet")
    assert parallel.dealt(scan).rdd.getNumPartitions() == 4
    monkeypatch.setattr(parallel, "DEAL_BYTES", 1000)
    assert parallel.dealt(scan).rdd.getNumPartitions() > 8


def test_documents_of_other_files_are_not_built(spark):
    """Files are chosen below the generator, so a load parses its own documents only."""
    from pyspark.sql import functions as F

    from civicflow import catalog
    df = catalog.report_docs(spark, SMALL, F.col("file_key") < catalog.REPORT_SPLIT_DAY)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan[plan.index("Repartition"):]
    assert df.count() == catalog.report_docs(spark, SMALL).where(F.col("file_key") < catalog.REPORT_SPLIT_DAY).count() > 0


def test_constraint_checks_normalise_once(spark, monkeypatch):
    from civicflow import catalog
    calls, normalize = [], catalog.reports.normalize
    monkeypatch.setattr(catalog.reports, "normalize", lambda *a: calls.append(a) or normalize(*a))
    catalog.QUERIES["constraint_checks"](spark, SMALL)
    assert len(calls) == 1
