"""Sums that follow a table, and the path index of documents: equal to a recomputation and to a full scan after any batches."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators import path_index
from civicflow.operators.upsert import upsert
from civicflow.plans import analytics, loads, reports
from civicflow.schemas import SPATIAL_EVENTS
from civicflow.sinks import snapshots
from civicflow.sinks.snapshots import Snapshot
from civicflow.streaming import incremental

DAY = datetime(2024, 1, 1)


def events(spark, rng, ids):
    rows = []
    for i in ids:
        at = None if rng.random() < 0.1 else DAY + timedelta(hours=rng.randint(0, 24 * 6))
        geom = None if rng.random() < 0.1 else (rng.randint(0, 30) / 10, rng.randint(0, 30) / 10)
        value = None if rng.random() < 0.2 else float(rng.randint(-50, 50)) / 4
        rows.append((i, at, geom, value, rng.choice(["a", "b", None]), "s"))
    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), SPATIAL_EVENTS["geom"],
                         T.StructField("value", T.DoubleType()), T.StructField("category", T.StringType()), T.StructField("source", T.StringType())])
    df = spark.createDataFrame(rows, kind)
    return df.withColumn("value_double", F.col("value")).withColumn("value", F.col("value").cast("decimal(38,10)"))


def put(table, batch):
    return table.merge(batch, loads.EVENT_KEY, lambda t, b: loads.upsert_events(t, b, unique=True))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("as_of", ["2024-01-07 00:00:00", "2024-01-06 13:30:00"])
def test_sums_equal_a_recomputation_after_every_batch(spark, tmp_dir, as_of):
    rng = random.Random(as_of)
    table = incremental.events_table(spark, f"{tmp_dir}/events")
    daily, cells = analytics.daily_sums(table, f"{tmp_dir}/daily"), analytics.cell_sums(table, f"{tmp_dir}/cells")
    assert daily.refresh() == 0 and daily.read().count() == 0
    for step in range(4):
        put(table, events(spark, rng, rng.sample(range(40), 15)))
        if step == 2:  # several versions at once
            put(table, events(spark, rng, [1, 2, 3]))
        for rollup in (daily, cells):
            assert rollup.refresh() == table.versions()[-1]
            assert rows(rollup.read()) == rows(rollup.sums(table.read()).select(*rollup.read().columns))
        assert rows(analytics.daily_avg_maintained(daily, as_of, 3)) == rows(analytics.daily_avg(table.read(), as_of, 3))
        assert rows(analytics.hotspots_maintained(cells, as_of, 3)) == rows(analytics.hotspots(table.read(), as_of, 3))
    # nothing to do: no version is made
    before = daily.table.versions()
    assert daily.refresh() == table.versions()[-1] and daily.table.versions() == before


def test_a_refresh_reads_changed_folders_only_and_starts_over_when_its_version_is_gone(spark, tmp_dir, monkeypatch):
    rng = random.Random(1)
    table = incremental.events_table(spark, f"{tmp_dir}/events")
    put(table, events(spark, rng, range(30)))
    daily = analytics.daily_sums(table, f"{tmp_dir}/daily")
    daily.refresh()
    read = []
    plain = Snapshot._read
    monkeypatch.setattr(Snapshot, "_read", lambda self, folders, *a: (read.append(folders) if self is table else None, plain(self, folders, *a))[1])
    now = plain(table, table.version().folders).where("ts is not null").first()
    put(table, plain(table, table.version().folders).where(F.col("id") == now["id"]).withColumn("category", F.lit("z")).drop("date"))
    del read[:]
    daily.refresh()
    assert sorted(len(f) for f in read) == [1, 1] and rows(daily.read()) == rows(daily.sums(plain(table, table.version().folders)).select(*daily.read().columns))
    monkeypatch.setattr(snapshots, "KEEP_VERSIONS", 1)
    put(table, events(spark, rng, [50]))
    put(table, events(spark, rng, [51]))
    assert daily.reached() not in table.versions()
    daily.refresh()
    assert rows(daily.read()) == rows(daily.sums(plain(table, table.version().folders)).select(*daily.read().columns))


# --------------------------------------------------------------------------

DOCS = [
    {"request_id": "A", "status": "open", "n": 1, "tags": ["x", "y"], "deep": {"a": {"b": [1, {"c": "z"}]}}},
    {"request_id": "B", "status": "closed", "n": 1.0, "tags": [], "deep": {"a": {"b": []}}, "k/~": "odd"},
    {"request_id": "C", "status": "open", "n": 2, "tags": "x", "no": None, "yes": True},
    {"request_id": "D", "status": {"open": "open"}, "tags": [["x"], {"t": "x"}], "yes": False, "e": {}, "0": "zero"},
    {"request_id": "E"},
]


def batch(spark, docs):
    df = spark.createDataFrame([("f", i, json.dumps(d)) for i, d in enumerate(docs)], "file_key string, pos long, doc string")
    return reports.to_table_rows(reports.dedupe(reports.normalize(df.select("file_key", "pos", F.parse_json("doc").alias("doc")))))


def tables(spark, tmp_dir, **options):
    return (Snapshot(spark, f"{tmp_dir}/t", reports.empty_table(spark).schema, buckets=["external_id"], **options),
            path_index.index_table(spark, f"{tmp_dir}/i", **options))


PATHS = [("$.status", "open"), ("$.status", "closed"), ("$.n", "1"), ("$.tags", "x"), ("$.tags[0]", "x"), ("$.deep.a.b[1].c", "z"), ("$['k/~']", "odd"),
         ("$.yes", "true"), ("$.status", '{"open":"open"}'), ("$.e", "{}"), ("$.no", "null"), ("$.nowhere", "x"), ("$['0']", "zero"), ("$", "x")]
PATTERNS = [{"status": "open"}, {"tags": ["x"]}, {"tags": ["y", "x"]}, {"deep": {"a": {"b": [{"c": "z"}]}}}, {"n": 1}, {"n": 1, "status": "open"}, {"no": None}, {},
            {"tags": []}, {"tags": [["x"]]}, {"tags": [{"t": "x"}]}, {"yes": True}, {"status": {"open": "open"}}, {"status": "x"}, [], "x", {"request_id": "E", "z": 1}]


def held(doc, pattern, top=True):
    """JSON containment, written out."""
    if isinstance(pattern, dict):
        return isinstance(doc, dict) and all(k in doc and held(doc[k], p, False) for k, p in pattern.items())
    if isinstance(pattern, list):
        return isinstance(doc, list) and all(any(held(e, p, False) for e in doc) for p in pattern)
    if top and isinstance(doc, list):
        return any(held(e, pattern, False) for e in doc)
    return not isinstance(doc, (dict, list)) and isinstance(doc, bool) == isinstance(pattern, bool) and doc == pattern


def test_index_equals_a_full_scan(spark, tmp_dir):
    table, index = tables(spark, tmp_dir)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    now = {}
    changed = [{"request_id": "A", "status": "closed", "tags": ["y"]}, {"request_id": "F", "status": "open", "deep": {"a": {"b": [{"c": "z"}]}}}]
    for docs in (DOCS, changed):
        reports.merge_reports(table, batch(spark, docs), stamp, index)
        now |= {d["request_id"]: d for d in docs}
        for path, value in PATHS:
            want = sorted(r["external_id"] for r in reports.search(table.read(), path, value).collect())
            assert sorted(r["external_id"] for r in path_index.search(table, index, path, value).collect()) == want, path
        for pattern in PATTERNS:
            want = sorted(k for k, d in now.items() if held(d, pattern))
            assert sorted(r["external_id"] for r in path_index.find_containing(table, index, pattern).collect()) == want, pattern
    # stale postings are gone: the index holds what a fresh one would
    fresh = path_index.postings_of(table.read(), "external_id", "original_doc")
    assert rows(index.read()) == rows(fresh.select(*index.read().columns))


def test_a_search_reads_the_buckets_of_its_path_and_value(spark, tmp_dir):
    table, index = tables(spark, tmp_dir, bucket_rows=20)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    for lo in (0, 100):
        reports.merge_reports(table, batch(spark, [{"request_id": f"R{i}", "status": f"s{i}", "type": "same"} for i in range(lo, lo + 100)]), stamp, index)
    folders = index.version().folders
    assert len(folders) > 16
    keys = path_index._holders(index, "/status", "s7")
    read = {f.rsplit("/", 2)[1] for f in keys.inputFiles()}
    assert 1 <= len(read) <= path_index.PARTS and len(read) < len({f.rsplit("/", 1)[1] for f in folders})
    assert [r["key"] for r in keys.collect()] == ["R7"]
    assert path_index.search(table, index, "$.type", "same").count() == 200
    # a process that died between the commits: new postings are there, stale ones do no harm
    docs = batch(spark, [{"request_id": "R1", "status": "new"}])
    path_index.add(index, docs.select("external_id", "original_doc"), "external_id", "original_doc")
    assert path_index.search(table, index, "$.status", "s1").count() == 1 and path_index.search(table, index, "$.status", "new").count() == 0
    table.merge(docs, ["external_id"], lambda t, b: upsert(t, b, ["external_id"], ["original_doc"]))
    assert path_index.search(table, index, "$.status", "s1").count() == 0 and path_index.search(table, index, "$.status", "new").count() == 1


def test_pointers():
    assert [path_index.pointer(p) for p in ("$", "$.a.b[3]", "$['a b']", '$["x/~"].c')] == ["", "/a/b/3", "/a b", "/x~1~0/c"]
    with pytest.raises(ValueError):
        path_index.pointer("a.b")
