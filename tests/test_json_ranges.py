"""Large JSON lists in many tasks: the same documents and positions as the whole read, whatever the text and the split places."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from civicflow.sources import json_ranges, json_reports

VALUES = [{"id": "x"}, {"a": {"b": [1, {"c": "}"}]}, "t": 'q"uote'}, {"t": "[{,]}\\"}, {"t": "\\\\\" \\"}, [], {}, [[1, 2], [3]], "text", "a,b", 1, -2.5, True,
          None, "", {"k": "é中😀"}, {"t": "x" * 300}, {"t": "}" * 40}, {"": ["\n\t"]}]


@pytest.fixture()
def small_splits(spark):
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode())


def found(df):
    rows = df.select(F.regexp_extract("file_path", "[^/]*$", 0).alias("f"), "pos", F.to_json("doc").alias("d")).collect()
    return sorted((r["f"], r["pos"], r["d"]) for r in rows if True)


def whole(spark, path):
    return found(json_reports.documents_of(json_reports.read_files(spark, path))), sorted(
        r["file_path"] for r in json_reports.parse_files(json_reports.read_files(spark, path)).where("docs is null").collect())


def ranged(spark, path):
    return found(json_reports.scan(spark, path)), sorted(r["file_path"] for r in json_reports.quarantine(spark, path).collect())


def test_equals_the_whole_read(spark, tmp_dir, small_splits):
    rng = random.Random(4)
    for i in range(8):
        items = [rng.choice(VALUES) for _ in range(rng.randint(20, 60))]
        text = json.dumps(items, ensure_ascii=bool(i % 2), indent=[None, 2, None][i % 3], separators=(",", ":") if i % 3 == 0 else None)
        write(f"{tmp_dir}/in/f{i}.json", ["", " \n"][i % 2] + text + ["", "\n", "  \n\n"][i % 3])
    good = whole(spark, f"{tmp_dir}/in")
    assert len(good[0]) > 160 and good[1] == []
    assert ranged(spark, f"{tmp_dir}/in") == good


def test_bad_files_go_whole_and_others_are_read_as_before(spark, tmp_dir, small_splits):
    many = ",".join('{"id":%d}' % i for i in range(30))
    texts = {"good": f"[{many}]", "cut": f"[{many}", "cut2": f'[{many},"open', "cut3": f"[{many},", "comma": f"[{many},]", "twice": f"[{many},,1]", "curly": f"[{many}}}",
             "word": f"[{many}, nonsense, 1]", "nested": f"[{many},{{]}}]", "behind": f"[{many}] and {{more}} of [this, and that]", "one": '{"id":"%s"}' % ("x" * 400), "text": "hello " * 60,
             "empty": "", "blank": " " * 300, "none": "[" + " \n" * 200 + "]", "one_long": '[{"t":"%s"}]' % ("},{" * 200), "bom": f"﻿[{many}]",
             "keys": '[{"a":1,"a":2},' + many + "]", "mixed": f"[1}},{many}]"}
    for name, text in texts.items():
        write(f"{tmp_dir}/in/{name}.json", text)
    want = whole(spark, f"{tmp_dir}/in")
    got = ranged(spark, f"{tmp_dir}/in")
    assert {f for f, _, _ in want[0]} == {f for f, _, _ in got[0]}
    assert got == want
    assert json_reports.scan(spark, f"{tmp_dir}/in", "good.json").count() == 30


def test_a_large_list_is_many_tasks(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/in/a b%20é.json", "[" + ", ".join('{"id": %d, "t": "},{"}' % i for i in range(200)) + "]")
    parts = json_ranges.pieces(spark, [f"{tmp_dir}/in/a b%20é.json"], "}")
    assert parts.rdd.getNumPartitions() > 50
    assert [(p, json.loads(d)["id"]) for _, p, d in found(json_reports.scan(spark, f"{tmp_dir}/in"))] == [(i, i) for i in range(200)]


def test_marks():
    text = rb'{"a\"b":"\\","c,\\\"[":[1,2]},"x'
    m = json_ranges.marks(text)
    at, sign, depth = json_ranges.structure(m, False)
    assert [chr(text[i]) for i in at] == list("{,[,]},") and depth.tolist() == [1, 1, 2, 2, 1, 0, 0]
    assert m.quotes % 2 == 1
