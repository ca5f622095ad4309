"""Line dedup against a brute-force version, on hard cases and for any number of batches."""

import pytest
from pyspark.sql import functions as F

from cases import DOCS, empty, frame
from civicflow.llm import line_runs
from civicflow.llm.line_runs import KEY, LineRuns, drop_lines, merging

LONG = "a line of more than twenty characters"


def brute(rows, least_chars=20, least_documents=3):
    """(id, n_lines, n_dropped, text) of each (id, text)."""
    def key(line):
        k = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
        return k if len(k) >= least_chars else None

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if key(line):
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = []
        for line in lines:
            h = holders.get(key(line), ())
            keeper = max((x for x in h if x is not None), default=None)
            if len(h) < least_documents or i == keeper:
                left.append(line)
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def rows():
    out = [(1, f"{LONG}\nonce only, and long enough\n\n"), (2, f"  {LONG.upper()}\t\r\nshort"), (3, f"{LONG}\n{LONG}\nx"), (4, None), (5, ""),
           (6, "\n\n"), (7, "twice in two documents ..\nß" + "é" * 19), (8, "twice in two documents ..\nß" + "é" * 19), (9, "ß" + "é" * 19 + "\nß" + "é" * 18),
           (10, "ß" + "é" * 18), (11, "ß" + "é" * 18), (12, "x\u0085" + LONG), (13, f" {LONG}"), (13, f"{LONG} "), (None, LONG), (None, f"{LONG}\n{LONG}"),
           (14, "É" + "A" * 30), (15, "É" + "a" * 30), (16, "é" + "a" * 30), (17, "É" + "A" * 30 + " "), (18, "w" * 200_000)]
    hot = "the line that a third of all documents hold"
    out += [(100 + i, "\n".join([hot] * (i % 3 > 0) + [f"line number {i % 7} of the cycle of seven", f"own line of document {i}, {i}"])) for i in range(60)]
    out += [(200, "\n".join([hot] * 5000 + ["another ending of that long text"])), (200, hot)]
    return out


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()], key=str)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (6, 3)])
def test_brute(spark, batches, fanout):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert got(drop_lines(docs, batches=batches, fanout=fanout)) == brute(data)


def test_hard_and_empty_inputs(spark):
    docs = frame(spark).withColumns({"hi": F.lit(1), "Doc": F.lit(2), "N_Lines": F.lit(3), "a`b": F.lit(4)})
    found = drop_lines(docs)
    assert found.columns == [*DOCS.names, "hi", "Doc", "a`b", "n_lines", "n_dropped", "kept_text"]
    assert got(found) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert drop_lines(empty(spark)).collect() == []


def test_runs_are_levelled_and_each_key_is_in_one(spark):
    store = LineRuns(spark, fanout=2)
    try:
        for b in range(5):
            keys = spark.range(b * 50, b * 50 + 100).select(F.col("id").alias("hi"), (-F.col("id")).alias("lo"),
                                                            F.lit(1).cast("long").alias("docs"), F.lit(9 - b).cast("long").alias("keeper"))
            store.add(keys)
        assert [len(level) for level in store.levels] == [1, 0, 1]
        found = {r["hi"]: (r["docs"], r["keeper"]) for r in store.counted().collect()}
        assert len(found) == 300
        assert found == {i: (1 + (50 <= i < 250), 9 - max(0, i // 50 - 1)) for i in range(300)}
        # a run is read as it lies: neither shuffled nor sorted again
        with merging(spark):
            plan = store.unseen(spark.table(store.again[0]))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Sort [" not in plan
        assert set(KEY) < set(spark.table(store.again[0]).columns)
    finally:
        store.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_digest():
    assert line_runs.digest(" ABC" * 6) == line_runs.digest("abc " * 6 + "\r") and line_runs.digest("x" * 19) is None
    assert line_runs.digest("É" * 20) != line_runs.digest("é" * 20)
