"""Range checks, reasons, metrics and the partitioned write."""

from pyspark.sql import functions as F

from civicflow.functions import quality as Q
from civicflow.operators import validate as V
from civicflow.plans import ingest
from civicflow.sources import fixtures

from conftest import SMALL


def test_range_endpoints_nan_inf_and_text(spark):
    rows = [
        ("1", "2024-01-01 00:00:00", "90", "180", "0", "a", "s"),
        ("2", "2024-01-01 00:00:00", "-90", "-180", "inf", "a", "s"),
        ("3", "2024-01-01 00:00:00", "90.0001", "0", "1", "a", "s"),
        ("4", "2024-01-01 00:00:00", "NaN", "NaN", "NaN", "a", "s"),
        ("5", "2024-01-01 00:00:00", None, "abc", "-0.5", "a", "s"),
        ("6", "not a time", "0", "0", "1", "a", "s"),
        ("7", None, "0", "0", "1", None, "s"),
    ]
    raw = spark.createDataFrame(rows, "id string, ts string, latitude string, longitude string, value string, "
                                      "category string, source string")
    got = {r["id"]: (r["is_valid"], Q.REASON_SEPARATOR.join(r["reasons"]))
           for r in V.check(raw).collect()}
    assert got["1"] == (True, "") and got["2"] == (True, "")
    assert got["3"] == (False, "latitude invalide")
    assert got["4"] == (False, "latitude invalide, longitude invalide, valeur invalide")
    assert got["5"] == (False, "latitude invalide, longitude invalide, valeur invalide")
    assert got["6"] == (False, "timestamp invalide")
    assert got["7"] == (True, "")


def test_reject_message_and_pct(spark):
    raw = spark.createDataFrame([("9", "2024-01-01 00:00:00", "95", "0", "1", "a", "s")],
                                "id string, ts string, latitude string, longitude string, value string, "
                                "category string, source string")
    r = V.rejects(V.check(raw), F.lit("run1")).first()
    assert r["message"] == "Run:run1 | ID:9 | Rejet: latitude invalide"
    pct = spark.createDataFrame([(821, 10000), (1, 3), (0, 0)], "b long, t long").select(
        Q.error_pct_text(F.col("b"), F.col("t"))).collect()
    assert [p[0] for p in pct] == ["8.21%", "33.33%", None]


def test_job_metrics_match_aggregate_and_rerun_is_idempotent(spark, tmp_dir):
    raw = fixtures.raw_ev(spark, SMALL)
    res = ingest.validate_and_partition(spark, raw, f"{tmp_dir}/clean", f"{tmp_dir}/rejects")
    m = res.metrics.agg(F.sum("rows_read"), F.sum("rows_written"), F.sum("bad_records_count"),
                        F.sum("rows_unpartitioned")).first()
    assert m[0] == raw.count() == m[1] + m[2] + m[3]
    written = spark.read.parquet(f"{tmp_dir}/clean")
    assert written.count() == m[1]
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == m[2]
    # rerun one landing day: only its own files are replaced
    day = raw.where(F.col("ds") == F.lit("2024-01-05").cast("date"))
    ingest.validate_and_partition(spark, day, f"{tmp_dir}/clean", f"{tmp_dir}/rejects")
    assert spark.read.parquet(f"{tmp_dir}/clean").count() == m[1]


def test_category_from_path_for_foreign_files(spark, tmp_dir):
    from civicflow.sources.events_files import category_from_path
    a = spark.createDataFrame([(1, None), (2, None)], "id int, category string")
    b = spark.createDataFrame([(3, "own"), (4, None)], "id int, category string")
    a.coalesce(1).write.parquet(f"{tmp_dir}/events/date=2024-01-01/category=noise/")
    b.coalesce(1).write.parquet(f"{tmp_dir}/events/date=2024-01-01/category=other/")
    df = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/events")
    got = sorted(tuple(r) for r in category_from_path(df).select("id", "category").collect())
    # a file with no category at all takes it from its path; otherwise the file's values stay
    assert got == [(1, "noise"), (2, "noise"), (3, "own"), (4, None)]


def test_one_pass_table_checks_equal_separate_checks(spark):
    from civicflow.operators import constraints as C
    df = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, None, "y"), (None, "c", None), (None, "d", "z")],
                               "k int, a string, b string")
    one = C.table_checks(df, "t", ["a", "b"], ["k"])
    separate = C.report(C.not_null(df, "t", ["a", "b"]), C.unique(df, "t", ["k"]))
    assert sorted(map(tuple, C.report(one).collect())) == sorted(map(tuple, separate.collect()))
    assert {r["rule"]: r["violations"] for r in one.collect()} == {"a not null": 1, "b not null": 2, "(k) unique": 1}


def test_special_category_round_trips_and_null_category_is_not_written(spark, tmp_dir):
    rows = [("1", "2024-01-01 10:00:00", "1", "1", "1", "a/b=c", "s", "2024-01-01"),
            ("2", "2024-01-01 11:00:00", "1", "1", "1", None, "s", "2024-01-01")]
    raw = spark.createDataFrame(rows, "id string, ts string, latitude string, longitude string, value string, "
                                      "category string, source string, ds string") \
        .withColumn("ds", F.col("ds").cast("date"))
    res = ingest.validate_and_partition(spark, raw, f"{tmp_dir}/clean", f"{tmp_dir}/rej")
    back = spark.read.parquet(f"{tmp_dir}/clean").collect()
    assert [(r["id"], r["category"]) for r in back] == [("1", "a/b=c")]
    m = res.metrics.first()
    assert (m["rows_read"], m["rows_written"], m["rows_unpartitioned"]) == (2, 1, 1)


def test_reject_without_an_id_column_logs_na(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "95", "0", "1", "a", "s")],
                                "ts string, latitude string, longitude string, value string, category string, "
                                "source string")
    r = V.rejects(V.check(raw), F.lit("run1")).first()
    assert r["id"] is None and r["message"] == "Run:run1 | ID:N/A | Rejet: latitude invalide"
