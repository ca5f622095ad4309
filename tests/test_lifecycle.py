"""Runs that fail, are empty or are repeated; landed bytes; category text; one rule for the last row of an id."""

import os

import pytest
from pyspark.sql import functions as F

from civicflow.plans import ingest, jobs
from civicflow.sinks import landing
from civicflow.sources import events_files
from civicflow.streaming import incremental

HEADER = "id,timestamp,latitude,longitude,value,category,source\n"


def _land(lake, ds, text, name="events.csv"):
    folder = f"{lake}/raw/events/date={ds}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def _row(i, ds="2024-01-05", category="007", value="1.5", ts="10:00:00"):
    return f"{i},{ds} {ts},6.1,1.2,{value},{category},s\n"


def test_failed_missing_and_empty_runs(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    with pytest.raises(FileNotFoundError):
        jobs.validate(spark, lake, "2024-01-04", "2024-01-04 02:00:00")
    _land(lake, "2024-01-05", HEADER)
    _land(lake, "2024-01-06", HEADER + _row(1) + _row(2))
    assert jobs.validate(spark, lake, "2024-01-05", "2024-01-05 02:00:00").first()["rows_read"] == 0
    assert jobs.validate(spark, lake, "2024-01-06", "2024-01-06 02:00:00").first()["rows_written"] == 2
    table = {str(r["execution_date"])[:10]: r for r in jobs.metrics_table(spark, lake).read().collect()}
    assert (table["2024-01-04"]["status"], table["2024-01-04"]["rows_read"]) == ("FAILED", 0)
    assert "no CSV landed" in table["2024-01-04"]["error_message"]
    assert (table["2024-01-05"]["status"], table["2024-01-05"]["rows_read"]) == ("SUCCESS", 0)
    assert table["2024-01-06"]["rows_written"] == 2
    _land(lake, "2024-01-04", HEADER + _row(9))
    jobs.validate(spark, lake, "2024-01-04", "2024-01-07 02:00:00")
    again = jobs.metrics_table(spark, lake).read().where("execution_date = '2024-01-04'").first()
    assert (again["status"], again["rows_written"]) == ("SUCCESS", 1)


def test_a_rerun_replaces_the_whole_day(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    _land(lake, "2024-01-05", HEADER + _row(1) + _row(2, category="a") + _row(3, value="bad") + _row(4, ds="2024-01-03"))
    _land(lake, "2024-01-06", HEADER + _row(8))
    for ds in ("2024-01-05", "2024-01-06"):
        jobs.validate(spark, lake, ds)
    _land(lake, "2024-01-05", HEADER + _row(1))
    m = jobs.validate(spark, lake, "2024-01-05").first()
    clean = events_files.scan_clean(spark, f"{lake}/clean/events")
    assert sorted(r["id"] for r in clean.collect()) == ["1", "8"] and m["rows_written"] == 1
    assert not os.path.exists(f"{lake}/rejects/run_date=2024-01-05")
    assert not [d for d in os.listdir(f"{lake}/clean/events") if d.startswith("_")]


def test_a_category_stays_the_text_it_is(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    categories = ["007", "08", "2024-01-01", "1e3", "true", "a b/c=d"]
    _land(lake, "2024-01-05", HEADER + "".join(_row(i, category=c) for i, c in enumerate(categories)))
    jobs.validate(spark, lake, "2024-01-05")
    jobs.load_clean(spark, lake, "L0")
    jobs.to_spatial(spark, lake)
    batch = sorted(map(tuple, jobs.events_table(spark, lake).read().select("id", "category").collect()))
    assert batch == list(enumerate(categories))
    incremental.run_available(spark, f"{lake}/clean/events", f"{tmp_dir}/stream", f"{tmp_dir}/ckpt")
    stream = incremental.events_table(spark, f"{tmp_dir}/stream").read().select("id", "category")
    assert sorted(map(tuple, stream.collect())) == batch


def test_the_later_landing_wins_everywhere(spark, tmp_dir):
    """A correction with an earlier ts: daily stream, one-run stream and batch give the same table."""
    lake = f"{tmp_dir}/lake"
    _land(lake, "2024-01-05", HEADER + _row(5, value="1") + _row(6))
    _land(lake, "2024-01-06", HEADER + _row(5, value="2", ts="08:00:00"))
    for ds in ("2024-01-05", "2024-01-06"):
        jobs.validate(spark, lake, ds)
        incremental.run_available(spark, f"{lake}/clean/events", f"{tmp_dir}/daily", f"{tmp_dir}/daily-ckpt")
    incremental.run_available(spark, f"{lake}/clean/events", f"{tmp_dir}/once", f"{tmp_dir}/once-ckpt")
    jobs.load_clean(spark, lake, "L0")
    jobs.to_spatial(spark, lake)
    tables = [incremental.events_table(spark, p).read() for p in (f"{tmp_dir}/daily", f"{tmp_dir}/once")]
    tables.append(jobs.events_table(spark, lake).read())
    for t in tables:
        assert {r["id"]: r["value_double"] for r in t.collect()} == {5: 2.0, 6: 1.5}


def test_rows_without_an_id_are_rejected_and_huge_values_stay(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    _land(lake, "2024-01-05", HEADER + _row("") + _row(1, value="inf") + _row(2, value="1e30") + _row(3, value="5d") + _row(4))
    m = jobs.validate(spark, lake, "2024-01-05").first()
    assert (m["rows_read"], m["rows_written"], m["bad_records_count"]) == (5, 3, 2)
    reasons = sorted(r["reasons"] for r in spark.read.parquet(f"{lake}/rejects").collect())
    assert reasons == ["id manquant", "valeur invalide"]
    jobs.load_clean(spark, lake, "L0")
    jobs.to_spatial(spark, lake)
    got = {r["id"]: (r["value"] is None, r["value_double"]) for r in jobs.events_table(spark, lake).read().collect()}
    assert got == {1: (True, float("inf")), 2: (True, 1e30), 4: (False, 1.5)}


def test_csv_files_keep_their_own_headers(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    _land(lake, "2024-01-05", HEADER + _row(1))
    _land(lake, "2024-01-06", "\ufefflongitude,latitude,note,id,timestamp,value,category\n"
          '1.2,6.1,"a ""q"" b\nnext, line",2,2024-01-06 00:00:00,3,c\n')
    got = {r["id"]: r for r in events_files.scan_csv(spark, f"{lake}/raw/events").collect()}
    assert all((r["latitude"], r["longitude"]) == ("6.1", "1.2") for r in got.values()) and set(got) == {"1", "2"}
    assert got["2"]["source"] is None and str(got["2"]["ds"]) == "2024-01-06"
    assert [r["id"] for r in events_files.scan_csv(spark, f"{lake}/raw/events", "2024-01-06").collect()] == ["2"]


def test_landed_files_are_the_source_files(spark, tmp_dir):
    """Ragged rows, quotes, a date column, no final line break, Parquet: byte for byte, extension kept."""
    os.makedirs(f"{tmp_dir}/src/date=1/.hidden")
    text = b'id,date\r\n1,x,EXTRA\n2,"a ""q""\n b"\n\n3'
    for path in ("one.csv", "src/a.csv", "src/date=1/b.csv", "src/_SUCCESS", "src/date=1/.hidden/c"):
        with open(f"{tmp_dir}/{path}", "wb") as f:
            f.write(text)
    spark.range(10).write.parquet(f"{tmp_dir}/table.parquet")
    for _ in range(2):
        landing.land_source(spark, "one", f"{tmp_dir}/one.csv", f"{tmp_dir}/raw", "2024-01-05")
        landing.land_source(spark, "many", f"{tmp_dir}/src", f"{tmp_dir}/raw", "2024-01-05")
        landing.land_source(spark, "table", f"{tmp_dir}/table.parquet", f"{tmp_dir}/raw", "2024-01-05")

    def files(root):
        return {os.path.relpath(f"{d}/{n}", root) for d, _, names in os.walk(root) for n in names if not n.endswith(".crc")}

    assert files(f"{tmp_dir}/raw/one") == {"date=2024-01-05/one.csv"}
    assert files(f"{tmp_dir}/raw/many") == {"date=2024-01-05/a.csv", "date=2024-01-05/date=1/b.csv"}
    for path in ("one/date=2024-01-05/one.csv", "many/date=2024-01-05/date=1/b.csv"):
        with open(f"{tmp_dir}/raw/{path}", "rb") as f:
            assert f.read() == text
    assert spark.read.parquet(f"{tmp_dir}/raw/table/date=2024-01-05").count() == 10


def test_only_json_files_are_reports_and_each_file_counts_its_ids(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    folder = f"{lake}/raw/{jobs.REPORTS_SOURCE}/date=2024-01-05"
    os.makedirs(folder)
    doc = '{"id":"%s","date":"2024-01-05","category":"c","state":"done","geo":"6.5d, 1f"}'
    for name, ids in (("a.json", "xyx"), ("b.json", "xz"), ("c.txt", "q")):
        with open(f"{folder}/{name}", "w") as f:
            f.write("[" + ",".join(doc % i for i in ids) + "]")
    totals = {r["metric"]: r["value"] for r in jobs.citizen_reports(spark, lake, "2024-01-05 03:00:00").collect()}
    assert totals == {"documents": 5, "reports_processed": 4, "files": 2, "quarantined_files": 0}
    table = jobs.reports_table(spark, lake).read()
    assert sorted(r["external_id"] for r in table.collect()) == ["x", "y", "z"]
    assert table.where(F.col("geom").isNotNull()).count() == 0  # numbers with a type suffix are no coordinates


def test_run_metrics_has_a_row_for_a_day_without_rows(spark):
    from civicflow.operators import validate as V
    raw = spark.createDataFrame([("1", None, "1", "1", "1", "c", "s")],
                                "id string, ts string, latitude string, longitude string, value string, category string, source string"
                                ).withColumn("ds", F.lit("2024-01-05").cast("date"))
    got = {str(r["execution_date"])[:10]: (r["rows_read"], r["high_error"], r["error_rate"])
           for r in ingest.run_metrics(V.check(raw), ["2024-01-05", "2024-01-06"]).collect()}
    assert got == {"2024-01-05": (1, False, 0.0), "2024-01-06": (0, False, None)}
