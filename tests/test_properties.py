"""Randomised checks against plain-Python statements of the reference rules."""

import json
import random
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import functions as F

from civicflow.functions.dates import normalize_date
from civicflow.operators import validate as V

# text or number as it may stand in a document, and the timestamp it means
DATE_CASES = [
    ("2024-01-05", "2024-01-05 00:00:00"), ("05/01/2024", "2024-01-05 00:00:00"), ("2024/01/05", "2024-01-05 00:00:00"),
    ("2024-01-05T06:07:08", "2024-01-05 06:07:08"), ("2024-01-05T06:07:08.25", "2024-01-05 06:07:08.250000"),
    ("2024-01-05T06:07:08.245775", "2024-01-05 06:07:08.245775"), ("  2024-01-05 ", "2024-01-05 00:00:00"),
    ("2024-1-5", "2024-01-05 00:00:00"), ("5/1/2024", "2024-01-05 00:00:00"), (1704067200, "2024-01-01 00:00:00"),
    (True, "1970-01-01 00:00:01"), ("2024-02-29", "2024-02-29 00:00:00"),
    ("2023-02-29", None), ("31/02/2024", None), ("2024-13-01", None), ("01-05-2024", None), ("2024-01-05Z", None),
    ("junk", None), ("", None), (0, None), (False, None), (None, None),
]


def _written(rng, t):
    """A random way to write the moment ``t`` that keeps its day, or all of it."""
    day = [f"{t:%Y-%m-%d}", f"{t:%d/%m/%Y}", f"{t:%Y/%m/%d}", f"{t.year}-{t.month}-{t.day}", f"  {t:%Y-%m-%d} "]
    k = rng.randrange(8)
    if k < len(day):
        return day[k], t.replace(hour=0, minute=0, second=0, microsecond=0)
    if k == 5:
        return f"{t:%Y-%m-%dT%H:%M:%S}", t.replace(microsecond=0)
    if k == 6:
        return f"{t:%Y-%m-%dT%H:%M:%S}.{t.microsecond:06d}", t
    return int(t.replace(microsecond=0, tzinfo=timezone.utc).timestamp()), t.replace(microsecond=0)


def test_dates_written_in_every_layout_come_back(spark):
    rng = random.Random(11)
    cases = [(v, want and datetime.fromisoformat(want)) for v, want in DATE_CASES]
    for _ in range(1500):
        cases.append(_written(rng, datetime(1990, 1, 1) + timedelta(microseconds=rng.randrange(40 * 365 * 86_400 * 10**6))))
    df = spark.createDataFrame([(i, json.dumps(v)) for i, (v, _) in enumerate(cases)], "i int, v string")
    got = dict(df.select("i", normalize_date(F.parse_json("v")).alias("t")).collect())
    for i, (v, want) in enumerate(cases):
        assert got[i] == want, (v, got[i], want)


def test_range_checks_match_pandas(spark):
    rng = random.Random(5)
    pool = ["90", "-90", "90.0000001", "-180", "180", "180.5", "0", "-0", "1e2", "abc", "", "nan", "inf",
            "-inf", "-1.5", "0.0", " 12 ", None]
    rows = [(str(i), "2024-01-01 00:00:00", rng.choice(pool), rng.choice(pool), rng.choice(pool), "c", "s")
            for i in range(2000)]
    raw = spark.createDataFrame(rows, "id string, ts string, latitude string, longitude string, value string, "
                                      "category string, source string")
    got = {r["id"]: (r["lat_ok"], r["lon_ok"], r["value_ok"]) for r in V.check(raw).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "ts", "latitude", "longitude", "value", "category", "source"])
    lat = pd.to_numeric(pdf["latitude"], errors="coerce")
    lon = pd.to_numeric(pdf["longitude"], errors="coerce")
    want_lat = lat.between(-90, 90)
    want_lon = lon.between(-180, 180)
    want_val = pd.to_numeric(pdf["value"], errors="coerce").fillna(-1) >= 0
    for i, rid in enumerate(pdf["id"]):
        assert got[rid] == (bool(want_lat[i]), bool(want_lon[i]), bool(want_val[i])), rows[i]


def test_upsert_matches_a_dict_model(spark):
    from civicflow.operators.upsert import upsert
    rng = random.Random(3)
    for trial in range(4):
        target = {k: (f"r{rng.randint(0, 9)}", f"k{rng.randint(0, 9)}") for k in rng.sample(range(60), 30)}
        batch = {k: (rng.choice([None, f"n{rng.randint(0, 9)}"]),) for k in rng.sample(range(60), 25)}
        # the rule: replaced column takes the batch value (NULL included), kept column stays,
        # a new key gets the batch value and the default for the kept column
        want = {}
        for k, (r, kept) in target.items():
            want[k] = (batch[k][0], kept) if k in batch else (r, kept)
        for k, (r,) in batch.items():
            if k not in target:
                want[k] = (r, "default")
        t = spark.createDataFrame([(k, r, kp) for k, (r, kp) in target.items()], "k int, r string, kept string")
        b = spark.createDataFrame([(k, r) for k, (r,) in batch.items()], "k int, r string")
        for strategy in ("broadcast", "shuffle"):
            out = upsert(t, b, ["k"], ["r"], insert_defaults={"kept": F.lit("default")}, strategy=strategy)
            got = {row["k"]: (row["r"], row["kept"]) for row in out.collect()}
            assert got == want, (trial, strategy)


def test_hot_cell_on_the_shuffle_path(spark):
    from civicflow.operators.spatial_join import region_table, within_join
    from civicflow.schemas import REGION_SOURCE
    square = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}'
    regions = region_table(spark.createDataFrame([(1, "sq", square)], REGION_SOURCE))
    rng = random.Random(9)
    pts = [(i, 1.0, 1.0) for i in range(1000)]  # one spot holds a third of all points
    pts += [(1000 + i, rng.uniform(-1, 3), rng.uniform(-1, 3)) for i in range(2000)]
    points = spark.createDataFrame(pts, "pid int, lon double, lat double")
    want = sorted(p for p, x, y in pts if 0 < x < 2 and 0 < y < 2)
    for bcast in (10**9, 0):
        got = sorted(r["pid"] for r in within_join(points, regions, broadcast_max_edges=bcast,
                                                   broadcast_max_cells=bcast).collect())
        assert got == want
