"""Region sources and their table: well-known binary, constraints, the load job, the spatial reference."""

import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from civicflow import catalog
from civicflow.functions.geo import SRID, srid_of
from civicflow.operators import constraints as C
from civicflow.operators.upsert import upsert, written_and_measured
from civicflow.plans import jobs, reports
from civicflow.sinks.snapshots import Snapshot
from civicflow.sources import wkb
from civicflow.streaming import incremental

from conftest import SMALL

SHAPES = [
    {"type": "Point", "coordinates": [1.5, -2.0]},
    {"type": "LineString", "coordinates": [[0.0, 0.0], [1.0, 1.0], [2.0, 0.5]]},
    {"type": "Polygon", "coordinates": [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]], [[1.0, 0.5], [2.0, 0.5], [2.0, 1.0], [1.0, 0.5]]]},
    {"type": "MultiPoint", "coordinates": [[1.0, 2.0], [3.0, 4.0]]},
    {"type": "MultiLineString", "coordinates": [[[0.0, 0.0], [1.0, 1.0]], [[5.0, 5.0], [6.0, 7.0]]]},
    {"type": "MultiPolygon", "coordinates": [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]], [[[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 5.0]]]]},
]
SHAPES.append({"type": "GeometryCollection", "geometries": [SHAPES[0], {"type": "GeometryCollection", "geometries": [SHAPES[2]]}]})
CODES = {name: code for code, name in wkb.TYPES.items()}


def encoded(g, order="<", z=0, srid=None, iso=False):
    """A geometry as well-known binary; z: extra ordinates."""
    code = CODES[g["type"]]
    flags = (1000 * z if iso else 0x80000000) if z else 0
    head = struct.pack("B", order == "<") + struct.pack(f"{order}I", code + flags + (0x20000000 if srid else 0))
    head += struct.pack(f"{order}I", srid) if srid else b""

    def position(p):
        return struct.pack(f"{order}{2 + bool(z)}d", *p, *[9.0] * bool(z))

    def line(ps):
        return struct.pack(f"{order}I", len(ps)) + b"".join(map(position, ps))

    kind, c = g["type"], g.get("coordinates")
    if kind == "Point":
        return head + position(c)
    if kind == "LineString":
        return head + line(c)
    if kind == "Polygon":
        return head + struct.pack(f"{order}I", len(c)) + b"".join(map(line, c))
    parts = g["geometries"] if kind == "GeometryCollection" else [{"type": kind.removeprefix("Multi"), "coordinates": p} for p in c]
    return head + struct.pack(f"{order}I", len(parts)) + b"".join(encoded(p, order, z, None, iso) for p in parts)


@pytest.mark.parametrize("form", [{}, {"order": ">"}, {"z": 1}, {"z": 1, "iso": True}, {"srid": 4326}])
def test_binary_geometries(form):
    for g in SHAPES:
        data = encoded(g, **form)
        assert json.loads(wkb.decoded(data)) == g
        assert wkb.decoded(data[:-1]) is None and wkb.decoded(data + b"x") is None
    assert wkb.decoded(None) is None and wkb.decoded(b"") is None and wkb.decoded(b"\x07") is None
    assert wkb.decoded(struct.pack("<BII", 1, 2, 0xFFFFFFFF)) is None and wkb.decoded(struct.pack("<BI", 1, 99)) is None
    assert json.loads(wkb.decoded(struct.pack("<BI2d", 1, 1, float("nan"), float("nan")))) == {"type": "MultiPoint", "coordinates": []}


def test_regions_are_loaded_by_id_and_refused_by_rule(spark, tmp_dir):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]}
    lake = f"{tmp_dir}/lake"

    def load(name, rows):
        os.makedirs(tmp_dir, exist_ok=True)
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows))
        return sorted((r["id"], r["reasons"]) for r in jobs.load_regions(spark, lake, f"{tmp_dir}/{name}.json").collect())

    bad = load("one", [{"id": 1, "name": "a", "geojson": json.dumps(square)}, {"id": 2, "name": "b", "wkb": encoded(SHAPES[2]).hex()},
                       {"id": 3, "name": "c", "wkb": "zz"}, {"id": 4, "name": "d", "geojson": "{"}, {"id": None, "name": "e", "geojson": json.dumps(square)},
                       {"id": 6, "geojson": json.dumps(square)}, {"id": 7, "name": "g", "geojson": json.dumps(square)}, {"id": 8, "name": "g", "geojson": json.dumps(square)}])
    assert bad == [(3, ["json invalide"]), (4, ["json invalide"])]
    table = jobs.regions_table(spark, lake)
    assert sorted((r["id"], r["name"]) for r in table.read().collect())[:2] == [(1, "a"), (2, "b")] and table.read().count() == 3
    refused = sorted(r["rule"] for r in table.quarantined().collect())
    assert refused == ["(name) unique", "id not null", "name not null"]
    # a name that another region has is refused; one that its holder gives up in the same load is free
    load("two", [{"id": 9, "name": "a", "geojson": json.dumps(square)}])
    assert table.read().count() == 3 and table.quarantined().count() == 4
    load("three", [{"id": 1, "name": "z", "geojson": json.dumps(square)}, {"id": 9, "name": "a", "geojson": json.dumps(square)}])
    assert sorted((r["id"], r["name"]) for r in table.read().collect() if r["id"] in (1, 9)) == [(1, "z"), (9, "a")]
    assert jobs.read_regions(spark, f"{tmp_dir}/one.json").count() == 6


def test_two_writers_at_once_cannot_both_take_a_name(spark, tmp_dir):
    table = jobs.regions_table(spark, f"{tmp_dir}/lake")
    table.bucket_rows = 1

    def rows(*items):
        return spark.createDataFrame([(i, n, "{}") for i, n in items], "id int, name string, geojson string")

    def put(batch, between=lambda: None):
        def change(current, b):
            between()
            return upsert(current, b, ["id"], ["name", "geojson"])
        table.merge(batch, ["id"], change)

    put(rows(*[(i, f"n{i}") for i in range(8)]))
    other = []
    put(rows((100, "new"), (101, "mine")), lambda: other or other.append(put(rows((200, "new")))))
    names = [r["name"] for r in table.read().collect()]
    assert len(names) == len(set(names)) == 10 and "mine" in names
    assert [r["rule"] for r in table.quarantined().collect()] == ["(name) unique"]
    assert [r["id"] for r in table.read().where("name = 'new'").collect()] == [200]


def test_refused_rows_are_all_kept_and_a_hot_key_is_one_row(spark, tmp_dir):
    table = Snapshot(spark, f"{tmp_dir}/t", catalog.PIPELINE_METRICS, buckets=["run_id", "table_target"])
    rows = spark.range(0, 3000, 1, 6).select(
        F.lit("d").alias("dag_id"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("run_id"),
        F.when(F.col("id") % 100 != 7, "t").alias("table_target"), F.lit("2024-01-01").cast("timestamp_ntz").alias("execution_date"),
        F.col("id").alias("rows_read"), F.lit("S").alias("status"))
    key = ["run_id", "table_target"]
    table.merge(rows, key, lambda t, b: upsert(t, b, key, ["rows_read"]))
    good = rows.filter("table_target is not null")
    assert table.read().count() == good.select(*key).distinct().count()
    counts = {r["rule"]: r["count"] for r in table.quarantined().groupBy("rule").count().collect()}
    assert counts == {"table_target not null": 30, "(run_id, table_target) unique": good.count() - table.read().count()}
    # the same batch again is refused the same way: which row stays does not depend on partitions
    before = sorted(map(tuple, table.read().collect()), key=str)
    table.merge(rows.repartition(3), key, lambda t, b: upsert(t, b, key, ["rows_read"]))
    assert sorted(map(tuple, table.read().collect()), key=str) == before


def test_a_batch_without_violations_is_merged_as_it_is(spark):
    batch, _, _ = written_and_measured(spark.range(5).selectExpr("id AS k", "id AS u"))
    assert not C.violated(batch, ["k"], [["k"], ["u"]], {("u",): spark.range(9, 10).selectExpr("id AS u")})
    assert C.violated(batch, ["k"], [["k"]], {("u",): spark.range(4, 5).selectExpr("id AS u")})


def test_geometry_columns_name_their_reference(spark, tmp_dir):
    events = catalog.spatial_events(spark, SMALL)
    assert srid_of(events, "geom") == SRID == 4326
    table = incremental.events_table(spark, f"{tmp_dir}/events")
    table.commit(events)
    assert srid_of(table.read(), "geom") == SRID
    events.write.parquet(f"{tmp_dir}/plain")
    assert srid_of(spark.read.parquet(f"{tmp_dir}/plain"), "geom") == SRID
    rows = reports.to_table_rows(reports.dedupe(reports.normalize(catalog.report_docs(spark, SMALL))))
    assert srid_of(rows, "geom") == SRID
    reported = incremental.reports_table(spark, f"{tmp_dir}/reports")
    reported.merge(rows, reports.REPORT_KEY, lambda t, b: reports.upsert_reports(t, b, F.lit("2024-01-01").cast("timestamp_ntz")))
    assert srid_of(reported.read(), "geom") == SRID
