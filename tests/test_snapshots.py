"""Snapshots: writers at once, buckets that grow, epochs that are played again."""

import os
import threading
from datetime import datetime
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.upsert import upsert
from civicflow.plans import ingest
from civicflow.plans.loads import EVENT_KEY, upsert_events
from civicflow.schemas import SPATIAL_EVENTS
from civicflow.sinks import snapshots
from civicflow.sinks.snapshots import Conflict, Snapshot, cover, publish
from civicflow.sources import fixtures
from civicflow.streaming import incremental

from conftest import SMALL

PAIRS = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def events(spark, *items):
    return spark.createDataFrame([(i, datetime.fromisoformat(t), None, None, c, "s", None) for i, t, c in items], SPATIAL_EVENTS)


def put(table, batch, hook=lambda: None, calls=None):
    def change(current, rows):
        if calls is not None:
            calls.append(1)
        hook()
        return upsert_events(current, rows, unique=True)
    return table.merge(batch, EVENT_KEY, change)


def content(table):
    return sorted((r["id"], str(r["date"]), r["category"]) for r in table.read().collect())


@pytest.mark.parametrize("stores", [("file",), ()])
def test_a_version_is_created_once_and_whole(spark, tmp_dir, monkeypatch, stores):
    # without links: the way of stores that put a file at the end of its stream
    monkeypatch.setattr(snapshots, "LINKING", stores)
    assert publish(spark, f"{tmp_dir}/v/1", "one\n") and not publish(spark, f"{tmp_dir}/v/1", "two\n")
    with open(f"{tmp_dir}/v/1") as f:
        assert f.read() == "one\n"
    assert [n for n in os.listdir(f"{tmp_dir}/v") if not n.endswith(".crc")] == ["1"]


def test_of_writers_at_once_one_creates_the_version(spark, tmp_dir):
    won, start = [], threading.Barrier(4)

    def write(i):
        start.wait()
        for n in range(5):
            if publish(spark, f"{tmp_dir}/v/{n}", f"{i}\n" * 1000):
                won.append((n, i))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(n for n, _ in won) == list(range(5))
    for n, i in won:
        with open(f"{tmp_dir}/v/{n}") as f:
            assert f.read() == f"{i}\n" * 1000


def test_two_writers_of_one_day_lose_nothing(spark, tmp_dir):
    table = incremental.events_table(spark, f"{tmp_dir}/t")
    put(table, events(spark, (1, "2024-01-01", "a")))
    both = threading.Barrier(2)
    calls, errors = [], []
    first = [True, True]

    def meet(i):
        # both have read version 1 before either commits
        if first[i]:
            first[i] = False
            both.wait(60)

    def run(i):
        try:
            mine = incremental.events_table(spark, f"{tmp_dir}/t")
            put(mine, events(spark, (1, "2024-01-01", f"w{i}"), (10 + i, "2024-01-01", "n")), partial(meet, i), calls)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and len(calls) == 3 and table.versions() == [1, 2, 3]
    got = content(table)
    assert got[1:] == [(10, "2024-01-01", "n"), (11, "2024-01-01", "n")] and got[0][2] in ("w0", "w1")
    # folders of the write that was done again are gone
    named = {f.split("/")[0] for v in table.versions() for f in table.folders(v)}
    assert {d for d in os.listdir(f"{tmp_dir}/t") if d.startswith("c=")} == named


def test_a_merge_goes_on_top_of_one_that_left_its_days_alone(spark, tmp_dir):
    table = incremental.events_table(spark, f"{tmp_dir}/t")
    put(table, events(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "a"), (3, "2024-01-03", "a")))
    calls, other = [], []

    def between():
        if not other:
            other.append(put(table, events(spark, (2, "2024-01-02", "b"), (7, "2024-01-04", "b"))))

    put(table, events(spark, (1, "2024-01-01", "c")), between, calls)
    assert len(calls) == 1 and table.versions() == [1, 2, 3]
    assert content(table) == [(1, "2024-01-01", "c"), (2, "2024-01-02", "b"), (3, "2024-01-03", "a"), (7, "2024-01-04", "b")]


def test_a_key_that_another_writer_put_on_another_day_is_found(spark, tmp_dir):
    table = incremental.events_table(spark, f"{tmp_dir}/t")
    put(table, events(spark, (1, "2024-01-01", "a")))
    calls, other = [], []

    def between():
        if not other:
            other.append(put(table, events(spark, (5, "2024-01-05", "theirs"))))

    put(table, events(spark, (5, "2024-01-06", "mine")), between, calls)
    assert len(calls) == 2 and content(table) == [(1, "2024-01-01", "a"), (5, "2024-01-06", "mine")]


def test_updates_are_computed_again_and_give_up_at_last(spark, tmp_dir, monkeypatch):
    table = Snapshot(spark, f"{tmp_dir}/t", PAIRS)
    table.commit(spark.createDataFrame([("a", 1)], PAIRS))
    seen = []

    def add(rows):
        if len(seen) < 2:
            seen.append(1)
            table.commit(table.read().selectExpr("k", "v + 10 AS v"))
        return rows.selectExpr("k", "v * 2 AS v")

    table.update(add)
    assert [tuple(r) for r in table.read().collect()] == [("a", 42)]
    monkeypatch.setattr(snapshots, "ATTEMPTS", 2)
    seen[:] = [0] * -5
    with pytest.raises(Conflict):
        table.update(lambda rows: (table.commit(rows), rows)[1])


def test_cover():
    assert cover([]) == [""] and cover(["00", "01"]) == ["00", "01", "1"] and cover(["1011"]) == ["0", "100", "1010", "1011", "11"]
    assert cover(["0", "10", "11"]) == ["0", "10", "11"]


def pairs(spark, *items):
    return spark.createDataFrame([(str(k), v) for k, v in items], PAIRS)


def merge(table, batch, done=None):
    return table.merge(batch, ["k"], lambda t, b: upsert(t, b, ["k"], ["v"]), done)


def test_buckets_divide_as_they_grow_and_a_batch_rewrites_its_own(spark, tmp_dir):
    table = Snapshot(spark, f"{tmp_dir}/t", PAIRS, buckets=["k"], bucket_rows=50)
    want = {}
    for step in range(4):
        batch = {i: step * 1000 + i for i in range(step * 100, step * 100 + 200)}
        merge(table, pairs(spark, *batch.items()))
        want |= batch
        got = {r["k"]: r["v"] for r in table.read().collect()}
        assert got == {str(k): v for k, v in want.items()} and table.read().columns == ["k", "v"]
    folders = table.folders(4)
    prefixes = [f.rsplit("=r", 1)[1] for f in folders]
    assert len(prefixes) == len(set(prefixes)) > 8 and cover(prefixes) == sorted(prefixes)
    # one key: one bucket is written, all others are shared
    merge(table, pairs(spark, (7, -1)))
    assert len(set(table.folders(5)) - set(folders)) == 1 and len(set(folders) - set(table.folders(5))) == 1
    assert table.read().count() == 500 and [tuple(r) for r in table.find("7").collect()] == [("7", -1)]
    assert table.find("nowhere").collect() == []
    found = table.find("7", "8")
    assert 1 <= len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 2


def test_a_null_key_has_a_bucket(spark, tmp_dir):
    table = Snapshot(spark, f"{tmp_dir}/t", PAIRS, buckets=["k"], bucket_rows=2)
    table.commit(spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("c", 4)], PAIRS))
    merge(table, pairs(spark, ("a", 5), ("d", 6)))
    assert sorted((str(r["k"]), r["v"]) for r in table.read().collect()) == [("None", 1), ("a", 5), ("b", 3), ("c", 4), ("d", 6)]


def test_two_writers_of_buckets(spark, tmp_dir):
    table = Snapshot(spark, f"{tmp_dir}/t", PAIRS, buckets=["k"], bucket_rows=20)
    merge(table, pairs(spark, *[(i, 0) for i in range(200)]))
    merge(table, pairs(spark, *[(i, 0) for i in range(200)]))
    of = {r["k"]: r["b"] for r in table.read().select("k", table._bucket(table._prefixes(table.version().folders)).alias("b")).collect()}
    a, same = next((x, y) for x in of for y in of if x < y and of[x] == of[y])
    far = next(x for x in of if of[x] != of[a])
    for other, times in ((far, 1), (same, 2)):
        calls, done = [], []

        def change(t, b):
            calls.append(1)
            if not done:
                done.append(merge(table, pairs(spark, (other, 5))))
            return upsert(t, b, ["k"], ["v"])

        table.merge(pairs(spark, (a, 7)), ["k"], change)
        got = {r["k"]: r["v"] for r in table.read().collect()}
        assert len(calls) == times and got[a] == 7 and got[other] == 5 and len(got) == 200


def test_an_epoch_played_again_makes_no_version(spark, tmp_dir):
    table = Snapshot(spark, f"{tmp_dir}/t", PAIRS, buckets=["k"])
    assert merge(table, pairs(spark, ("a", 1)), ("s", 0)) == 1
    assert merge(table, pairs(spark, ("a", 2)), ("s", 0)) == 1 and merge(table, pairs(spark, ("a", 2)), ("s", 1)) == 2
    assert merge(table, pairs(spark, ("a", 3)), ("other", 0)) == 3
    assert table.version().done == {"s": 1, "other": 0}
    assert table.update(lambda rows: rows, ("s", 1)) == 3 and table.update(lambda rows: rows, ("s", 2)) == 4
    assert [tuple(r) for r in table.read().collect()] == [("a", 3)]


def test_a_stream_that_died_between_the_two_commits_changes_nothing_when_it_comes_back(spark, tmp_dir):
    ingest.validate_and_partition(spark, fixtures.raw_ev(spark, SMALL), f"{tmp_dir}/clean", f"{tmp_dir}/rejects", with_metrics=False)
    args = (spark, f"{tmp_dir}/clean", f"{tmp_dir}/events", f"{tmp_dir}/_ckpt")
    incremental.run_available(*args)
    table = incremental.events_table(spark, f"{tmp_dir}/events")
    before, versions = content(table), table.versions()
    # the table's version is there, the checkpoint does not know it
    last = max(int(n) for n in os.listdir(f"{tmp_dir}/_ckpt/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{tmp_dir}/_ckpt/commits/{name}")
    # what the epoch would write now differs: it must not be written
    incremental.run_available(*args)
    assert str(last) in os.listdir(f"{tmp_dir}/_ckpt/commits")
    assert table.versions() == versions and content(table) == before
    # a new checkpoint is another stream: it loads all again
    incremental.run_available(*args[:3], f"{tmp_dir}/_ckpt2")
    assert len(table.versions()) == len(versions) + 1 and content(table) == before
    assert len(table.version().done) == 2
    assert table.read().where(F.col("date").isNull()).count() == 0
