"""Report shapes, date normalisation and the JSON file scan."""

from datetime import datetime

from pyspark.sql import functions as F

from civicflow.functions.dates import normalize_date
from civicflow.plans import reports
from civicflow.sources import json_reports


def _docs(spark, texts):
    df = spark.createDataFrame([(f"f{i:03d}", i, t) for i, t in enumerate(texts)], "file_key string, pos long, doc string")
    return df.select("file_key", "pos", F.parse_json("doc").alias("doc"))


def _norm(spark, texts):
    rows = reports.normalize(_docs(spark, texts)).drop("original_doc").orderBy("pos").collect()
    return [r.asDict() for r in rows]


def test_each_shape(spark):
    rows = _norm(spark, [
        '{"event":{"id":"A","timestamp":"2025-12-15","payload":{"type":"ROAD","commune":"C1","quartier":"Q1"}}}',
        '{"request_id":"B","created_at":"18/11/2025","type":"Water","city":"C2","district":"D2","status":"open"}',
        '{"id":"C","date":"2025/10/31","category":"Light","state":"done","geo":"6.5, 1.25"}',
        '{"_id":"D","date_creation":"2025-11-03T05:45:27.245775","type_demande":"X","statut":"new","localisation":{"commune":"C4","quartier":"Q4"}}',
        '{"ref":"E","date_signalement":"2025-11-03T05:45:27","service_type":"Y","status":"open","localisation":"Q5 - C5 - extra"}',
        '{"_id":"F","event_date":1704067200,"service":"Z","location":{"commune":"C6"}}',
        '{"created":"2025-01-02","type_demande":"W"}',
        '{"other":1}',
    ])
    assert [r["shape"] for r in rows] == [1, 2, 3, 4, 5, 6, 7, 0]
    assert [r["external_id"] for r in rows] == ["A", "B", "C", "D", "E", "F", None, None]
    assert [r["category"] for r in rows] == ["road", "water", "light", "x", "y", "z", "w", None]
    assert rows[0]["commune"] == "C1" and rows[0]["quartier"] == "Q1" and rows[0]["status"] is None
    assert rows[1]["source_timestamp"] == datetime(2025, 11, 18)
    assert (rows[2]["lat"], rows[2]["lon"]) == (6.5, 1.25)
    assert rows[3]["source_timestamp"] == datetime(2025, 11, 3, 5, 45, 27, 245775)
    assert (rows[4]["quartier"], rows[4]["commune"]) == ("Q5", "C5")
    assert rows[5]["source_timestamp"] == datetime(2024, 1, 1) and rows[5]["commune"] == "C6"


def test_null_keys_numeric_ids_and_bad_geo(spark):
    rows = _norm(spark, [
        '{"event":null}',                                        # present key with JSON null
        '{"request_id":12,"created_at":0}',                      # numeric id, falsy date
        '{"id":1.5e3,"date":"x","geo":"1,2,3"}',                 # three-part geo
        '{"id":"g","date":null,"geo":"a,1"}',                    # unparseable geo
        '{"id":"h","date":"2024-01-01","geo":{"lat":1}}',        # geo not a string
        '{"ref":"r","localisation":{"a":" - "}}',                # localisation not a string
    ])
    assert rows[0]["shape"] == 1 and rows[0]["external_id"] is None
    assert rows[1]["external_id"] == "12" and rows[1]["source_timestamp"] is None
    assert rows[2]["external_id"] == "1500.0"
    assert all(r["lat"] is None and r["lon"] is None for r in rows[2:5])
    assert rows[5]["commune"] is None and rows[5]["quartier"] is None


def test_date_values(spark):
    values = ['"2024-1-5"', '"05/01/2024"', '"2024/01/05"', '"2024-01-05T05:45:27.2"', '"2024-01-05T05:45:27"',
              '1704067200', '1704067200.5', '0', '""', 'false', 'true', 'null', '"not a date"', '"2024-01-05Z"',
              '{"a":1}', '" 2024-01-05 "']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(normalize_date(F.parse_json("v"))).collect()]
    assert got == [datetime(2024, 1, 5), datetime(2024, 1, 5), datetime(2024, 1, 5),
                   datetime(2024, 1, 5, 5, 45, 27, 200000), datetime(2024, 1, 5, 5, 45, 27),
                   datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 500000), None, None, None,
                   datetime(1970, 1, 1, 0, 0, 1), None, None, None, None, datetime(2024, 1, 5)]


def test_dedupe_keeps_last_file_then_position(spark):
    df = spark.createDataFrame([
        ("f1", 0, '{"request_id":"A","type":"one"}'),
        ("f1", 1, '{"request_id":"A","type":"two"}'),
        ("f2", 0, '{"request_id":"A","type":"three"}'),
        ("f1", 2, '{"request_id":"B","type":"b"}'),
        ("f1", 3, '{"created":"2024-01-01"}'),
    ], "file_key string, pos long, doc string").select("file_key", "pos", F.parse_json("doc").alias("doc"))
    got = {r["external_id"]: r["category"] for r in reports.dedupe(reports.normalize(df)).collect()}
    assert got == {"A": "three", "B": "b"}


def test_json_scan_lists_objects_and_quarantine(spark, tmp_dir):
    from pyspark.sql import types as T
    files = {
        "a.json": '[{"request_id":"A"},{"request_id":"B"}]',
        "b.json": '  {"request_id":"C"}\n',
        "c.json": '[]',
        "d.json": '[{"request_id":"D"}, {broken',
        "e.json": 'not json',
    }
    df = spark.createDataFrame([(k, v) for k, v in files.items()], T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))
    df.write.partitionBy("name").option("maxRecordsPerFile", 1).text(tmp_dir)
    docs = json_reports.scan(spark, tmp_dir)
    got = sorted((r["file_path"].split("name=")[1].split("/")[0], r["pos"],
                  r["doc"].toJson()) for r in docs.collect())
    assert got == [("a.json", 0, '{"request_id":"A"}'), ("a.json", 1, '{"request_id":"B"}'),
                   ("b.json", 0, '{"request_id":"C"}')]
    bad = sorted(r["file_path"].split("name=")[1].split("/")[0] for r in json_reports.quarantine(spark, tmp_dir).collect())
    assert bad == ["d.json", "e.json"]


def test_json_lines_landing_gives_the_same_reports(spark, tmp_dir):
    from civicflow.sinks import landing
    from civicflow.sources import fixtures

    from conftest import SMALL
    docs = fixtures.docs(spark, SMALL).select(F.substring("file_key", 6, 10).alias("date"), "pos", "doc")
    landing.write_json_lists(docs, f"{tmp_dir}/lists")
    landing.write_json_lines(docs, f"{tmp_dir}/lines")

    def table(scanned):
        d = scanned.select(F.col("file_path").alias("file_key"), "pos", "doc")
        return reports.dedupe(reports.normalize(d)).select("external_id", "category", "commune", "status")

    a = table(json_reports.scan(spark, f"{tmp_dir}/lists"))
    b = table(json_reports.scan_lines(spark, f"{tmp_dir}/lines"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert json_reports.quarantine_lines(spark, f"{tmp_dir}/lines").count() == 0


def test_repeated_key_keeps_the_last_value(spark):
    rows = _norm(spark, ['{"request_id":"A","type":"one","type":"two"}'])
    assert rows[0]["external_id"] == "A" and rows[0]["category"] == "two"
    files = spark.createDataFrame([("f", '[{"ref":"X","ref":"Y"}]')], "file_path string, value string")
    docs = json_reports.documents_of(files).collect()
    assert [d["doc"].toJson() for d in docs] == ['{"ref":"Y"}']
