"""The pipeline: columns between stages, decisions that take effect, and every stage on hard and empty inputs."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import SMALL, empty, frame
from civicflow.llm.stages import written
from test_jaccard import brute as groups
from test_scans import hits


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    columns, before = docs.columns, docs
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before = written(stage(spark, before, SMALL), name)
        results[name] = before
        if name != "tokens":
            assert before.columns == columns
    assert results["language_id"].count() == docs.count()  # clean documents stay
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    unique = sorted({c for _, _, c in groups(rows)})
    assert sorted(r["doc_id"] for r in results["near_duplicates"].collect()) == unique
    texts = dict(rows)
    clean = sorted(d for d in unique if not hits(texts[d], bench)[1])
    assert sorted(r["doc_id"] for r in results["decontamination"].collect()) == clean
    after = {r["doc_id"]: r for r in results["pii"].collect()}
    assert sorted(after) == clean
    private = re.compile(r"[\w.]+@[\w.]+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\w)\d{16}(?!\w)")
    for d in clean:
        assert len(private.findall(texts[d])) == len(private.findall(after[d]["text"]))
        assert not set(private.findall(texts[d])) & set(private.findall(after[d]["text"]))
        assert after[d]["n_chars"] == len(after[d]["text"])
    last = results["tokens"].collect()
    assert sorted(r["doc_id"] for r in last) == clean and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in last)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).drop("ids").collect()) == sorted(
        tuple(r) for r in results["tokens"].drop("ids").collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_hard_and_empty_inputs(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = frame(spark).withColumns({"k": F.lit(1), "N_Hit": F.lit(2), "doc": F.lit(3), "IDs": F.lit(4), "n_tokens": F.lit(5),
                                     "round_trip": F.lit(6), "decoded": F.lit(7), "n_entities": F.lit(8), "a`b.c": F.lit(9)})
    got = stage(spark, docs, SMALL)
    assert got.columns[:len(docs.columns)] == docs.columns
    assert len({c.lower() for c in got.columns}) == len(got.columns)
    kept = got.select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns[len(frame(spark).columns):]]).distinct().collect()
    assert [tuple(r) for r in kept] == [tuple(range(1, 10))]
    assert 0 < got.count() <= docs.count()
    assert stage(spark, empty(spark), SMALL).count() == 0
