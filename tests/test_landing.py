"""Source list and landing behaviour."""

import pytest
from pyspark.sql import functions as F

from civicflow.sinks import landing


def test_missing_or_broken_config_means_no_sources(spark, tmp_dir):
    assert landing.read_source_list(spark, f"{tmp_dir}/nope.json") == []
    spark.range(1).select(F.lit("{not json").alias("value")).write.text(f"{tmp_dir}/bad.json")
    assert landing.read_source_list(spark, f"{tmp_dir}/bad.json") == []


def test_names_are_normalised_and_missing_source_raises(spark, tmp_dir):
    cfg = F.to_json(F.array(F.struct(F.lit("Demandes Services").alias("name"),
                                     F.lit(f"{tmp_dir}/absent.json").alias("path"))))
    spark.range(1).select(cfg.alias("value")).write.text(f"{tmp_dir}/sources.json")
    assert landing.read_source_list(spark, f"{tmp_dir}/sources.json") == [
        ("demandes_services", f"{tmp_dir}/absent.json")]
    with pytest.raises(FileNotFoundError):
        landing.land_all(spark, f"{tmp_dir}/sources.json", f"{tmp_dir}/raw", "2024-01-01")


def test_landing_twice_is_idempotent(spark, tmp_dir):
    src = f"{tmp_dir}/src.csv"
    spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string").coalesce(1) \
        .write.option("header", True).csv(src)
    for _ in range(2):
        landing.land_source(spark, "events", src, f"{tmp_dir}/raw", "2024-01-01")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/raw/events")
    assert back.count() == 2


def test_csv_columns_are_matched_by_header_name(spark, tmp_dir):
    from civicflow.sources.events_files import scan_csv
    spark.createDataFrame([("5.0", "7", "1.5", "x", "2024-01-01 00:00:00", "10", "c")],
                          "value string, id string, latitude string, extra string, timestamp string, "
                          "longitude string, category string") \
        .coalesce(1).write.option("header", True).csv(f"{tmp_dir}/raw/events/date=2024-01-01")
    r = scan_csv(spark, f"{tmp_dir}/raw/events").first()
    assert (r["id"], r["value"], r["latitude"], r["longitude"], r["ts"], r["category"], r["source"]) == \
        ("7", "5.0", "1.5", "10", "2024-01-01 00:00:00", "c", None)
    assert str(r["ds"]) == "2024-01-01"


def test_foreign_clean_files_take_their_category_from_the_path(spark, tmp_dir):
    from civicflow.plans import loads
    from civicflow.sources.events_files import clean_folders, scan_foreign
    root = f"{tmp_dir}/clean"
    rows = "SELECT '%s' AS id, TIMESTAMP_NTZ '2024-01-0%s 01:00:00' AS %s, 1.5D AS latitude, 2 AS longitude, 3.5F AS value%s"

    def put(path, i, at, more=""):
        spark.sql(rows % (i, i, at, more)).coalesce(1).write.parquet(f"{root}/{path}")

    put("ingest_ds=2024-01-01/date=2024-01-01/category=own%2Fcategory", 1, "ts", ", 's' AS source")
    put("events/date=2024-01-02/category=a+b c%25é", 2, "timestamp", ", CAST(NULL AS STRING) AS category, 's' AS source")
    put("events/date=2024-01-03/category=folder", 3, "timestamp", ", 'file' AS category")
    put("category=top/ingest_ds=2024-01-09", 4, "timestamp")
    put("nowhere", 5, "timestamp")
    put("events/category=x/_hidden", 6, "timestamp")
    own, foreign = clean_folders(spark, root)
    assert len(own) == 1 and len(foreign) == 3
    got = {r["id"]: (r["category"], str(r["ts"]), r["longitude"], str(r["ingest_ds"])) for r in scan_foreign(spark, foreign).collect()}
    assert got == {"2": ("a+b c%é", "2024-01-02 01:00:00", 2.0, "None"), "3": ("file", "2024-01-03 01:00:00", 2.0, "None"),
                   "4": ("top", "2024-01-04 01:00:00", 2.0, "2024-01-09"), "5": (None, "2024-01-05 01:00:00", 2.0, "None")}
    totals = loads.clean_load(spark, root, f"{tmp_dir}/raw_events", "L").first()
    assert (totals["files_loaded"], totals["rows_loaded"]) == (5, 5)
    raw = {r["id"]: r["category"] for r in spark.read.parquet(f"{tmp_dir}/raw_events").collect()}
    assert raw["1"] == "own/category" and raw["2"] == "a+b c%é"
