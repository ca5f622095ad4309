"""Failure-safety of snapshots and the incremental load."""

from pyspark.sql import functions as F

from civicflow.plans import ingest
from civicflow.schemas import SPATIAL_EVENTS
from civicflow.sinks.snapshots import Snapshot
from civicflow.sources import fixtures
from civicflow.streaming import incremental

from conftest import SMALL


def test_half_written_version_is_ignored(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    snap = Snapshot(spark, f"{tmp_dir}/t", schema)
    assert snap.read().count() == 0
    snap.commit(spark.range(3).selectExpr("id AS k", "'a' AS v"))
    # a job that died before its commit leaves files that no version names
    spark.range(5).selectExpr("id AS k", "'b' AS v").write.parquet(f"{tmp_dir}/t/c=dead")
    open(f"{tmp_dir}/t/_versions/.c=dead", "w").close()
    assert snap.versions() == [1]
    assert {r["v"] for r in snap.read().collect()} == {"a"}
    assert snap.commit(spark.range(2).selectExpr("id AS k", "'c' AS v")) == 2
    assert {r["v"] for r in snap.read().collect()} == {"c"}


def test_a_merge_shares_the_folders_of_untouched_days(spark, tmp_dir):
    from datetime import datetime

    from civicflow.plans.loads import EVENT_KEY, upsert_events
    table = incremental.events_table(spark, f"{tmp_dir}/events")

    def rows(*items):
        return spark.createDataFrame([(i, datetime.fromisoformat(t) if t else None, None, None, c, "s", None) for i, t, c in items], SPATIAL_EVENTS)

    table.merge(rows((1, "2024-01-01", "a"), (2, "2024-01-02", "a"), (3, "2024-01-03", "a"), (4, None, "a")), EVENT_KEY, upsert_events)
    first = table.folders(1)
    # id 2 moves to day 5: its old day is rewritten, days 1, 3 and the undated rows are shared
    table.merge(rows((2, "2024-01-05", "b"), (9, "2024-01-05", "b")), EVENT_KEY, upsert_events)
    second = table.folders(2)
    days = {f.rsplit("/", 1)[1]: f for f in second}
    assert set(days) == {"date=2024-01-01", "date=2024-01-03", "date=2024-01-05", "date=__HIVE_DEFAULT_PARTITION__"}
    assert len(set(first) & set(second)) == 3
    got = {r["id"]: (str(r["date"]), r["category"]) for r in table.read().collect()}
    assert got == {1: ("2024-01-01", "a"), 2: ("2024-01-05", "b"), 3: ("2024-01-03", "a"), 4: ("None", "a"), 9: ("2024-01-05", "b")}


def test_old_versions_and_their_folders_go(spark, tmp_dir, monkeypatch):
    import os

    from civicflow.sinks import snapshots
    from pyspark.sql import types as T
    monkeypatch.setattr(snapshots, "KEEP_VERSIONS", 2)
    snap = Snapshot(spark, f"{tmp_dir}/t", T.StructType([T.StructField("k", T.LongType())]))
    for n in range(1, 5):
        assert snap.commit(spark.range(n).selectExpr("id AS k")) == n
    assert snap.versions() == [3, 4] and snap.read().count() == 4
    assert len([d for d in os.listdir(f"{tmp_dir}/t") if d.startswith("c=")]) == 2


def test_stream_rerun_without_new_files_changes_nothing(spark, tmp_dir):
    raw = fixtures.raw_ev(spark, SMALL)
    res = ingest.validate_and_partition(spark, raw, f"{tmp_dir}/clean", f"{tmp_dir}/rejects")
    written = res.metrics.agg(F.sum("rows_written")).first()[0]
    args = (spark, f"{tmp_dir}/clean", f"{tmp_dir}/events", f"{tmp_dir}/_ckpt")
    incremental.run_available(*args)
    table = Snapshot(spark, f"{tmp_dir}/events", SPATIAL_EVENTS)
    first = sorted(map(tuple, table.read().collect()))
    versions = table.versions()
    incremental.run_available(*args)
    assert table.versions() == versions
    assert sorted(map(tuple, table.read().collect())) == first
    assert len(first) == written
