"""Substring dedup against brute force: every window of every document in one counter."""

import hashlib
from collections import Counter

import pytest

from cases import SMALL, empty, frame, words
from civicflow.llm import queries, repeats


def brute(texts, window):
    seen = Counter()
    split = [words(t) for t in texts]
    for w in split:
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def key(x):
    return tuple((v is None, str(v)) for v in x)


@pytest.mark.parametrize("hot", [repeats.HOT, 400, 2])
def test_hard_cases(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = frame(spark)
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(((d, *b) for (d, _), b in zip(data, brute([t for _, t in data], 35))), key=key)
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs, keep=["doc_id"]).collect()), key=key)
    assert got == want


def test_oversize_groups_split_only_as_far_as_they_must(spark, monkeypatch):
    """Sentences with one beginning of 22 words and many ends: split at 24 words; a passage in all of them stays whole."""
    import random
    rng = random.Random(2)
    start = [f"s{i}" for i in range(22)]
    passage = " ".join(f"p{i}" for i in range(45))
    ends = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(40)) for _ in range(30)]
    texts = [f"x{i} " + " ".join(start) + f" {ends[i % 30]} y{i} {passage} z{i}" for i in range(90)]
    data = list(enumerate(texts))
    trees = []
    plain = repeats._trees
    monkeypatch.setattr(repeats, "_trees", lambda spans, window: trees.append(spans) or plain(spans, window))
    monkeypatch.setattr(repeats, "HOT", 35 * 40)
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in repeats.remove_repeats(docs, keep=["doc_id"]).collect())
    assert got == sorted((d, *b) for (d, _), b in zip(data, brute(texts, 35)))
    assert len(trees) == 2 and trees[1].count() > 0


def test_other_window_and_small_trees(spark, monkeypatch):
    """A tree of a few kilobytes at a time gives the same repeats."""
    monkeypatch.setattr(repeats, "TREE_BYTES", 4000)
    docs = frame(spark).filter("doc_id is not null")
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(((d, *b) for (d, _), b in zip(data, brute([t for _, t in data], 20))), key=key)
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs, window=20, keep=["doc_id"]).collect()), key=key)
    assert got == want


def test_clashing_columns_and_empty_table(spark):
    docs = frame(spark).selectExpr("doc_id", "text", "1 as N_Words", "source as k", "lang as `odd.name`")
    got = repeats.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "k", "odd.name", "n_words", "n_removed", "kept_text"]
    assert got.count() == docs.count()
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_query_on_the_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {d["doc_id"]: (n, r, hashlib.sha256(k.encode()).hexdigest())
            for d, (n, r, k) in zip(docs, brute([d["text"] for d in docs], 35))}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op2_substring_dedup"](spark, SMALL).collect()}
    assert got == want
