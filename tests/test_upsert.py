"""Upsert laws for the snapshot upserts."""

from pyspark.sql import functions as F

from civicflow.operators.upsert import keep_last, upsert
from civicflow.plans import reports


def _rows(df, key="k"):
    return sorted(tuple(r) for r in df.orderBy(key).collect())


def test_insert_replace_keep_and_defaults(spark):
    target = spark.createDataFrame([(1, "a", "x", 10), (2, "b", "y", 20)], "k int, r string, kept string, d int")
    batch = spark.createDataFrame([(2, None, "z"), (3, "c", "w")], "k int, r string, kept string")
    out = upsert(target, batch, ["k"], ["r"], insert_defaults={"d": F.lit(99)})
    assert _rows(out) == [(1, "a", "x", 10), (2, None, "y", 20), (3, "c", "w", 99)]


def test_same_batch_twice_equals_once_and_later_wins(spark):
    target = spark.createDataFrame([(1, "a")], "k int, r string")
    b1 = spark.createDataFrame([(1, "b"), (2, "c")], "k int, r string")
    b2 = spark.createDataFrame([(2, "d")], "k int, r string")
    once = upsert(target, b1, ["k"], ["r"])
    twice = upsert(once, b1, ["k"], ["r"])
    assert _rows(once) == _rows(twice)
    assert _rows(upsert(once, b2, ["k"], ["r"])) == [(1, "b"), (2, "d")]


def test_keep_last_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z")], "k int, o int, v string")
    assert _rows(keep_last(df, ["k"], ["o"])) == [(1, 5, "b")]


def test_reports_ingested_at_is_kept(spark):
    def batch(text):
        df = spark.createDataFrame([("f", 0, text)], "file_key string, pos long, doc string")
        docs = df.select("file_key", "pos", F.parse_json("doc").alias("doc"))
        return reports.to_table_rows(reports.dedupe(reports.normalize(docs)))
    t1 = reports.upsert_reports(reports.empty_table(spark), batch('{"request_id":"A","type":"one"}'),
                                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    t2 = reports.upsert_reports(t1, batch('{"request_id":"A","type":"two"}'),
                                F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    r = t2.first()
    assert r["category"] == "two" and str(r["ingested_at"]) == "2024-01-01 00:00:00"


def test_broadcast_and_shuffle_plans_agree(spark):
    target = spark.range(0, 1000).selectExpr("id AS k", "CAST(id AS STRING) AS r", "'t' AS kept")
    batch = spark.range(900, 1100).selectExpr("id AS k", "CAST(id * 2 AS STRING) AS r", "'b' AS kept")
    a = upsert(target, batch, ["k"], ["r"], strategy="broadcast")
    b = upsert(target, batch, ["k"], ["r"], strategy="shuffle")
    assert _rows(a) == _rows(b)
    assert a.count() == 1100
    plan = a._jdf.queryExecution().executedPlan().toString()
    # the target side of the broadcast plan is never hash-partitioned on the key
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_auto_falls_back_to_shuffle_when_the_batch_is_too_big(spark):
    from civicflow.operators.upsert import written_and_measured
    target = spark.range(0, 100).selectExpr("id AS k", "repeat('x', 100) AS r")
    batch = spark.range(50, 150).selectExpr("id AS k", "repeat('y', 100) AS r")
    _, rows, size = written_and_measured(batch)
    assert rows == 100 and size >= 100 * 100
    small = upsert(target, batch, ["k"], ["r"], broadcast_max_bytes=10**9)
    big = upsert(target, batch, ["k"], ["r"], broadcast_max_bytes=1000)
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert _rows(small) == _rows(big)


def test_metrics_retry_keeps_or_refreshes_the_error(spark):
    from civicflow.plans import ingest
    from civicflow.schemas import PIPELINE_METRICS
    import datetime as dt
    t0, t1, t2 = (dt.datetime(2024, 1, 5, h) for h in (1, 2, 3))
    target = spark.createDataFrame([("d", "r1", "events", t0, 10, 0, 1, "FAILED", "boom", t1, t1)], PIPELINE_METRICS)
    batch = spark.createDataFrame([("d2", "r1", "events", t2, 10, 9, 1, "SUCCESS", None, t2)],
                                  "dag_id string, run_id string, table_target string, execution_date timestamp_ntz, "
                                  "rows_read long, rows_written long, bad_records_count long, status string, "
                                  "error_message string, finished_at timestamp_ntz")
    kept = ingest.upsert_metrics(target, batch).first()
    assert (kept["status"], kept["error_message"], kept["dag_id"], kept["started_at"], kept["finished_at"]) == \
        ("SUCCESS", "boom", "d", t1, t2)
    assert ingest.upsert_metrics(target, batch, refresh_error=True).first()["error_message"] is None
