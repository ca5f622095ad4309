"""Copies by tasks: bytes, retries of killed tasks, commits that must be whole, swaps that are undone."""

import os
import subprocess
import sys

import pytest

from civicflow.sinks import copying, landing, tables
from civicflow.sinks.tables import hadoop_fs

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def files(root):
    return {os.path.relpath(f"{d}/{n}", root) for d, _, names in os.walk(root) for n in names if not n.endswith(".crc")}


def test_tasks_copy_and_the_driver_does_not(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(landing, "_copy_by_driver", None)
    monkeypatch.setattr(copying, "PIECE", 1000)
    os.makedirs(f"{tmp_dir}/src/a b/ü=1")
    sizes = {"one.bin": 0, "a b/two.bin": 999, "a b/ü=1/three.csv": 1000, "a b/ü=1/four%20.gz": 123_457}
    for name, size in sizes.items():
        with open(f"{tmp_dir}/src/{name}", "wb") as f:
            f.write(os.urandom(size))
    for _ in range(2):
        landing.land_source(spark, "s", f"{tmp_dir}/src", f"{tmp_dir}/raw", "2024-01-05")
    assert files(f"{tmp_dir}/raw") == {f"s/date=2024-01-05/{name}" for name in sizes}
    for name in sizes:
        with open(f"{tmp_dir}/src/{name}", "rb") as a, open(f"{tmp_dir}/raw/s/date=2024-01-05/{name}", "rb") as b:
            assert a.read() == b.read()


def test_a_rerun_with_fewer_files_replaces_the_day_and_an_empty_source_empties_it(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    for name in "ab":
        with open(f"{tmp_dir}/src/{name}", "w") as f:
            f.write(name)
    landing.land_source(spark, "s", f"{tmp_dir}/src", f"{tmp_dir}/raw", "2024-01-05")
    os.remove(f"{tmp_dir}/src/a")
    landing.land_source(spark, "s", f"{tmp_dir}/src", f"{tmp_dir}/raw", "2024-01-05")
    assert files(f"{tmp_dir}/raw") == {"s/date=2024-01-05/b"}
    os.remove(f"{tmp_dir}/src/b")
    landing.land_source(spark, "s", f"{tmp_dir}/src", f"{tmp_dir}/raw", "2024-01-05")
    assert files(f"{tmp_dir}/raw") == set()


def writer(tmp_dir, n):
    return copying.FileWriter({"scheme": "file", "authority": "", "folder": f"{tmp_dir}/out", "files": str(n)})


def row(tmp_dir, name, text, size=None):
    from pyspark.sql import Row
    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/{name}", "w") as f:
        f.write(text)
    return Row(from_scheme="file", from_authority="", from_path=f"{tmp_dir}/{name}", name=name, size=len(text) if size is None else size)


def test_a_commit_takes_each_file_once_from_the_attempts_that_ended(tmp_dir):
    class Dies(copying.FileWriter):
        def stream(self, source, target):
            target.write(b"half")
            raise OSError("killed")

    a, b = row(tmp_dir, "a", "text of a"), row(tmp_dir, "b", "text of b")
    with pytest.raises(OSError):
        Dies({"scheme": "file", "authority": "", "folder": f"{tmp_dir}/out", "files": "2"}).write(iter([a]))
    w = writer(tmp_dir, 2)
    first, again, other = w.write(iter([a])), w.write(iter([a])), w.write(iter([b]))
    with pytest.raises(OSError, match="3 copies of 2"):
        w.commit([first, again, other])
    with pytest.raises(OSError, match="1 copies of 2"):
        w.commit([first])
    w.commit([again, other, None])
    assert files(f"{tmp_dir}/out") == {"a", "b"}
    with open(f"{tmp_dir}/out/a") as f:
        assert f.read() == "text of a"


def test_a_source_that_changes_meanwhile_fails(tmp_dir):
    with pytest.raises(OSError, match="changed"):
        writer(tmp_dir, 1).write(iter([row(tmp_dir, "a", "longer than listed", 3)]))


KILLED = """
import os, sys
sys.path.insert(0, {repo!r})
from civicflow import session
from civicflow.sinks import copying
from civicflow.stores import Located

class Killed(copying.FileWriter):
    def stream(self, source, target):
        try:
            os.close(os.open({mark!r}, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return super().stream(source, target)
        target.write(b"half of it")
        target.flush()
        os._exit(1)

class Sink(copying.FileSink):
    @classmethod
    def name(cls):
        return "killed_once"
    def writer(self, schema, overwrite):
        return Killed(self.options)

spark = session.build("local[2,4]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {tmp!r} + "/ck"}})
names = ["a", "b", "c"]
copying.copy_files(spark, [(Located("file", "", {tmp!r} + "/" + n), n, os.path.getsize({tmp!r} + "/" + n)) for n in names],
                   Located("file", "", {tmp!r} + "/out"), Sink)
"""


def test_a_killed_task_is_retried(tmp_path):
    for n in "abc":
        (tmp_path / n).write_bytes(os.urandom(100_000))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", KILLED.format(repo=REPO, tmp=str(tmp_path), mark=str(tmp_path / "mark"))], cwd=tmp_path,
                          env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert (tmp_path / "mark").exists()  # one worker was killed
    assert files(tmp_path / "out") == {"a", "b", "c"}
    for n in "abc":
        assert (tmp_path / n).read_bytes() == (tmp_path / "out" / n).read_bytes()


class Failing:
    """A file system whose n-th rename fails or kills the process."""

    def __init__(self, fs, n, error):
        self.fs, self.left, self.error = fs, n, error

    def rename(self, a, b):
        self.left -= 1
        if self.left == 0:
            if self.error:
                raise self.error
            return False
        return self.fs.rename(a, b)

    def __getattr__(self, name):
        return getattr(self.fs, name)


def put(path, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/f", "w") as f:
        f.write(text)


def read(path):
    with open(f"{path}/f") as f:
        return f.read()


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_a_failed_swap_leaves_all_folders_as_they_were(spark, tmp_dir, n):
    for day in "12":
        put(f"{tmp_dir}/t/d={day}", f"old {day}")
        put(f"{tmp_dir}/new/d={day}", f"new {day}")
    fs, _, jvm = hadoop_fs(spark, tmp_dir)
    swaps = {f"{tmp_dir}/t/d={day}": f"{tmp_dir}/new/d={day}" for day in "12"}
    with pytest.raises(OSError):
        tables.swap_folders(Failing(fs, n, None), jvm, swaps)
    assert sorted(os.listdir(f"{tmp_dir}/t")) == ["d=1", "d=2"]
    assert [read(f"{tmp_dir}/t/d={day}") for day in "12"] == ["old 1", "old 2"]
    tables.swap_folders(fs, jvm, swaps)
    assert [read(f"{tmp_dir}/t/d={day}") for day in "12"] == ["new 1", "new 2"]


def test_the_next_swap_mends_one_that_died(spark, tmp_dir):
    fs, _, jvm = hadoop_fs(spark, tmp_dir)
    # died after the old folder went aside: it is put back, then replaced
    put(f"{tmp_dir}/t/_aside-d=1", "old")
    # died before the old folder was deleted
    put(f"{tmp_dir}/t/_aside-d=2", "older")
    put(f"{tmp_dir}/t/d=2", "old")
    put(f"{tmp_dir}/new/d=2", "new")
    tables.swap_folders(fs, jvm, {f"{tmp_dir}/t/d=1": f"{tmp_dir}/new/d=1", f"{tmp_dir}/t/d=2": f"{tmp_dir}/new/d=2"})
    assert sorted(os.listdir(f"{tmp_dir}/t")) == ["d=2"] and read(f"{tmp_dir}/t/d=2") == "new"


def test_folders_are_listed_at_once(spark, tmp_dir, monkeypatch):
    """The Hadoop client's listing, with calls for each file, is for stores that Arrow does not know."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(landing, "files_below", None)
    docs = spark.range(30).select(F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("date"), F.col("id").alias("pos"),
                                  F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit("}")).alias("doc"))
    landing.write_json_lists(docs, f"{tmp_dir}/lists", per_file=10)
    with open(f"{tmp_dir}/lists/_note", "w") as f:
        f.write("hidden")
    landing.land_source(spark, "s", f"{tmp_dir}/lists", f"{tmp_dir}/raw", "2024-01-05")
    landed = files(f"{tmp_dir}/raw")
    assert len(landed) == 9 and all(name.endswith(".json") for name in landed)
    assert {name.split("/")[2] for name in landed} == {"date=2024-01-01", "date=2024-01-02", "date=2024-01-03"}
    # checksum files have followed
    assert not [n for _, _, names in os.walk(f"{tmp_dir}/lists") for n in names if ".txt" in n]
    assert spark.read.text(f"{tmp_dir}/lists").count() == 9
