"""Large CSV files in many tasks: the same rows as the streamed read, whatever the quotes, line ends and split places."""

import os
import random

import pytest

from civicflow.sources import csv_ranges, events_files
from civicflow.sources.csv_ranges import Range, quoted_after

FIELDS = ["plain", "", '"q"', '"a ""b"" c"', '"two\nlines"', '"\n\n"', '"x,y"', 'in"ner', 'in"ner,', '"shut"tail', '"', '""', '""""', '"a"b"c', " ", '" sp "',
          '"' + "long " * 30 + "\n" + "text " * 30 + '"', "é中", '"é\r\n中"', '"open ""', "5' 6\""]
HEADER = "id,timestamp,latitude,longitude,value,category,source"


@pytest.fixture()
def small_splits(spark):
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def streamed(spark, path):
    df = (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path))
    return sorted((tuple(r) for r in df.select(*HEADER.split(",")).collect()), key=str)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode())


def split(spark, path):
    df = events_files.scan_csv(spark, path)
    return sorted((tuple(r) for r in df.select("id", "ts", "latitude", "longitude", "value", "category", "source").collect()), key=str), df


@pytest.mark.parametrize("seed", range(7))
def test_equals_the_streamed_read(spark, tmp_dir, small_splits, seed):
    rng = random.Random(seed)
    end = rng.choice(["\n", "\r\n"])
    fields = rng.sample(FIELDS, rng.randint(3, len(FIELDS)))
    # half of the inputs are well formed: quotes only around whole fields
    if seed % 2:
        fields = [f for f in fields if not f.strip('"') or f.startswith('"') == f.endswith('"') and f not in ('"', '""""', '"a"b"c', '"open ""')] or ["x"]
        fields = [f for f in fields if f != '"']
    lines = [HEADER] + [",".join([str(i)] + [rng.choice(fields) for _ in range(rng.choice([6, 6, 6, 4, 8]))]) for i in range(60)]
    if seed % 3 == 0:
        lines[10:10] = ["", ""]
    text = end.join(lines) + rng.choice(["", end])
    write(f"{tmp_dir}/day/events.csv", text)
    got, df = split(spark, f"{tmp_dir}/day")
    assert got == streamed(spark, f"{tmp_dir}/day/events.csv")
    assert df.rdd.getNumPartitions() > 5


def test_plain_files_are_split_without_python(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/day/events.csv", "﻿" + HEADER + "\n" + "".join(f'{i},2024-01-01,1,2,"3, 4",c,s\n' for i in range(100)))
    got, df = split(spark, f"{tmp_dir}/day")
    assert got == streamed(spark, f"{tmp_dir}/day/events.csv") and len(got) == 100
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "FileScan csv" in plan and df.rdd.getNumPartitions() > 5


def test_files_of_all_kinds_lie_side_by_side(spark, tmp_dir, small_splits):
    row = '{i},2024-01-0{d} 00:00:00,1.5,2.5,3,"c\nd",s\n'
    write(f"{tmp_dir}/raw/date=2024-01-01/a b%20.csv", HEADER + "\n" + "".join(row.format(i=i, d=1) for i in range(40)))
    write(f"{tmp_dir}/raw/date=2024-01-02/b.csv", "﻿value,id,note,ID2\n" + "".join(f'"{i}\n",{i},"n\n",x\n' for i in range(100, 140)))
    write(f"{tmp_dir}/raw/date=2024-01-02/small.csv", HEADER + "\n" + row.format(i=200, d=2))
    write(f"{tmp_dir}/raw/date=2024-01-03/odd.csv", '"id",value,"two\nlines"\n' + "".join(f"{i},7,8\n" for i in range(300, 340)))
    write(f"{tmp_dir}/raw/date=2024-01-03/empty.csv", "")
    write(f"{tmp_dir}/raw/date=2024-01-03/_hidden.csv", "id\n9\n")
    rows = {r["id"]: r for r in events_files.scan_csv(spark, f"{tmp_dir}/raw").collect()}
    assert sorted(map(int, rows)) == [*range(40), *range(100, 140), 200, *range(300, 340)]
    assert rows["5"]["category"] == rows["200"]["category"] == "c\nd" and str(rows["5"]["ds"]) == "2024-01-01"
    assert rows["105"]["value"] == "105\n" and rows["105"]["source"] is None and str(rows["105"]["ds"]) == "2024-01-02"
    assert rows["310"]["value"] == "7" and str(rows["310"]["ds"]) == "2024-01-03"
    assert events_files.scan_csv(spark, f"{tmp_dir}/raw", "2024-01-02").count() == 41


def test_a_record_longer_than_many_splits(spark, tmp_dir, small_splits):
    long = "line\n" * 400
    write(f"{tmp_dir}/day/events.csv", f'{HEADER}\n1,2024-01-01,1,2,3,"{long}",s\n2,2024-01-01,1,2,3,c,"{"w" * 3000}"\n3,2024-01-01,1,2,3,"{long}')
    got, _ = split(spark, f"{tmp_dir}/day")
    assert got == streamed(spark, f"{tmp_dir}/day/events.csv")
    assert [r[5] for r in got[:2]] == [long, "c"]


def test_headers_by_spark_where_tasks_cannot_open_the_store(spark, tmp_dir, monkeypatch):
    write(f"{tmp_dir}/day/a.csv", "id,value\n1,2\n")
    write(f"{tmp_dir}/day/b.csv", "﻿value,id\n")
    write(f"{tmp_dir}/day/c.csv", "id,value\n3,4")
    by_tasks = {h: len(p) for h, p in events_files.csv_headers(spark, events_files.listing(spark, f"{tmp_dir}/day")).items()}
    monkeypatch.setattr(events_files, "SCHEMES", {})
    by_spark = {h: len(p) for h, p in events_files.csv_headers(spark, events_files.listing(spark, f"{tmp_dir}/day")).items()}
    assert by_tasks == by_spark == {"id,value": 2, "value,id": 1}


def slow(text, quoted):
    """The places of a reader, one character at a time."""
    place = "quoted" if quoted else "start"
    for c in text:
        if place == "quoted":
            place = "behind" if c == '"' else "quoted"
        elif c == '"':
            place = {"start": "quoted", "behind": "quoted", "plain": "plain"}[place]
        else:
            place = "start" if c == "," else "plain"
    return place == "quoted"


def test_line_functions():
    rng = random.Random(1)
    for _ in range(3000):
        lines = ["".join(rng.choice('"",a') for _ in range(rng.randint(0, 9))) for _ in range(4)]
        for quoted in (False, True):
            state, closed, opened = quoted, False, False
            for line in lines:
                assert quoted_after(line.encode(), state) == slow(line, state)
                opened |= slow(line, False)
                state = slow(line, state)
                closed |= not state
            r = Range()
            r.add([x.encode() for x in lines[:2]])
            r.add([x.encode() for x in lines[2:]])
            out, inside, closes, opens, size = r.row()
            assert size == sum(len(x) + 1 for x in lines)
            assert (inside if quoted else out) == state and opens == opened
            if quoted:
                assert closes == closed


def test_names():
    assert events_files._named('id,"a ""b""",,ID') == ["id0", 'a "b"', "_c2", "ID3"]
    assert csv_ranges.quoted_after(b'a,"b', False)
