"""Ranked search against a brute-force version, on hard cases, small blocks and many groups of queries."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import empty, frame, rows, sentence
from civicflow.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, top=50):
    """{item_id: [(rank, doc_id, score)]}"""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, total = len(counted), sum(x for _, _, x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    out = {}
    for item, mine in queries.items():
        found = []
        for i, c, x in counted:
            m = 50 + 50 * x * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in mine if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        found = sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top]
        if found:
            out[item] = [(k + 1, i, -s) for k, (s, _, i) in enumerate(found)]
    return out


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


def questions():
    import random
    rng = random.Random(11)
    out = [(i, sentence(rng, rng.randint(1, 30))) for i in range(25)]
    return out + [(100, None), (101, ""), (102, " ... "), (103, "nowheretobefound"), (104, "The THE the été ÉTÉ 中文"), (None, "lone text of nobody"),
                  (105, "word"), (105, "text two"), (106, "x" * 50_000), (107, sentence(rng, 3000))]


@pytest.mark.parametrize("block,window,query_terms,top", [(4096, 1024, 200_000, 50), (7, 4, 300, 5), (16, 1024, 1, 3)])
def test_brute(spark, monkeypatch, block, window, query_terms, top):
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    monkeypatch.setattr(search, "WINDOW", window)
    data, asked = rows(), questions()
    items = spark.createDataFrame(asked, "item_id long, text string").repartition(3)
    found = got(search.search(frame(spark), items, top=top, query_terms=query_terms if query_terms > 1 else 1500))
    assert found == brute([(r[0], r[1]) for r in data], asked, top)


def test_other_names_and_empty_tables(spark):
    docs = frame(spark).withColumns({"item_id": F.lit(1), "Score": F.lit(2), "rank": F.lit(3)})
    items = spark.createDataFrame([("a", "word"), ("b", "text")], "item_id string, text string")
    found = got(search.search(docs, items))
    assert found == brute([(r[0], r[1]) for r in rows()], [("a", "word"), ("b", "text")])
    for d, i in ((empty(spark), items), (docs, items.limit(0)), (empty(spark), items.limit(0)), (docs.filter("doc_id = 301"), items)):
        none = search.search(d, i)
        assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_block_search_skips_and_loses_nothing(seed):
    rng = np.random.default_rng(seed)
    n = 5000
    lists = []
    for size, weight in [(4, 9000), (30, 7000), (300, 3000), (2000, 900), (3500, 300), (4800, 40)]:
        d = np.sort(rng.choice(n, size, replace=False))
        lists.append((d, weight * rng.integers(300_000, 900_000, size)))
    total = np.zeros(n, np.int64)
    for d, s in lists:
        total[d] += s
    ids = rng.permutation(n).astype(np.int64)
    want = sorted(zip((-total).tolist(), ids.tolist()))[:50]
    best = search.Best(50)
    scored = search.search_block(lists, n, best, ids, np.zeros(n, bool))
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == want
    assert scored < n / 2


def test_equal_scores_are_told_apart_by_id():
    n = 3000
    lists = [(np.arange(n), np.full(n, 5, np.int64))]
    best = search.Best(3)
    search.search_block(lists, n, best, np.arange(n, 0, -1), np.arange(n) == n - 1)
    assert best.ids.tolist() == [2, 3, 4]


def test_lengths_beyond_64_bits():
    counts, lengths = np.array([3, 1]), np.array([10 ** 9, 7])
    n, total = 10 ** 12, 10 ** 14
    want = [10 ** 9 * c // (1000 * c + 20 * (50 + 50 * x * n // total)) for c, x in zip(counts.tolist(), lengths.tolist())]
    assert search._parts(counts, lengths, n, total).tolist() == want
