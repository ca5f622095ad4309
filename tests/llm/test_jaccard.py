"""Near duplicates against all pairs."""

from collections import Counter, defaultdict

import pytest

from cases import SMALL, empty, frame, lower, words
from civicflow.llm import jaccard, queries
from civicflow.llm.components import connected


def shingle_set(text):
    w = words(lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """(id, size, component) of (id, text) rows."""
    sets = [shingle_set(t) for _, t in rows]
    postings = defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is not None:
            for x in s:
                postings[x].append(i)
    common = Counter((a, b) for p in postings.values() for k, a in enumerate(p) for b in p[k + 1:])
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), c in common.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def key(x):
    return tuple((v is None, str(v)) for v in x)


@pytest.mark.parametrize("rounds,block", [(2, 500), (0, 3)])
def test_hard_cases(spark, monkeypatch, rounds, block):
    """Also without leaders, all pairs counted over posting lists in many small blocks."""
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = frame(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_chain_of_near_copies(spark):
    """Links that connect a chain whose ends do not link."""
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(30):
        base = base[:i * 3] + [f"new{i}"] + base[i * 3 + 1:]
        rows.append((1000 - i, " ".join(base), None, None, None))
    docs = frame(spark, rows)
    got = [tuple(r) for r in jaccard.near_duplicates(docs).collect()]
    want = brute([(r[0], r[1]) for r in rows])
    assert sorted(got) == sorted(want)
    assert len({c for _, _, c in got}) < 30


def test_one_document_of_each_group_stays(spark):
    docs = frame(spark).withColumnRenamed("lang", "K").withColumnRenamed("source", "n")
    kept = jaccard.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = sorted({c for d, n, c in brute(rows) if d is not None})
    got = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert got == expected
    assert kept.filter("doc_id is null").count() == 2


def test_empty_table(spark):
    assert jaccard.near_duplicates(empty(spark)).count() == 0
    assert jaccard.deduplicate(empty(spark)).count() == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: n // 100 * 100 for n in {x for e in edges for x in e}}


def test_query_on_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.QUERIES["op8_jaccard_join"](spark, SMALL).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_groups_joined_by_one_bridging_version(spark):
    """A link whose common prefix shingles lie half in one group and half in the other."""
    sets = {}
    for g in range(6):
        core = [f"{g}c{i}" for i in range(79)]
        both = [f"{g}pa{i}" for i in range(5)] + [f"{g}pb{i}" for i in range(5)]
        for side, mine in (("a", both[:5]), ("b", both[5:])):
            bridge = [f"{g}{side}u{i}" for i in range(11)]
            sets[f"{g}{side}"] = core + both + bridge
            for v in range(6):
                # links with its side's bridging version (89 common words of 111), not with the other side's (84)
                sets[f"{g}{side}{v}"] = core + mine + bridge[:5] + [f"{g}{side}o{i}" for i in range(10)] + [f"{g}{side}v{v}"]
    ids = {name: i for i, name in enumerate(sorted(sets))}
    docs = frame(spark, [(ids[name], " ".join(s), None, None, None) for name, s in sets.items()])
    got = {i: c for i, _, c in (tuple(r) for r in jaccard.near_duplicates(docs, width=1).collect())}
    assert all(100 * len({*sets[f"{g}a"]} & {*sets[f"{g}b"]}) >= 80 * len({*sets[f"{g}a"]} | {*sets[f"{g}b"]}) for g in range(6))
    assert got == {ids[name]: ids[f"{name[0]}a"] for name in sets}


def test_an_id_on_texts_of_two_components(spark):
    """Each component keeps a document, also when one id is the smallest of both."""
    first, second = [" ".join(f"{x}{i}" for i in range(60)) for x in "ab"]
    rows = [(1, first), (1, second), (2, first + " more"), (3, second + " more")]
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows])
    assert sorted((r["doc_id"], r["text"]) for r in jaccard.deduplicate(docs).collect()) == [(1, first), (1, second)]


def test_all_links_and_their_number(spark):
    """The exact mode against all pairs, inside components too."""
    docs = frame(spark)
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    usable = [(i, frozenset(shingle_set(t))) for i, t in data if i is not None and shingle_set(t)]

    def linked(x, y):
        return 100 * len(x & y) >= 80 * len(x | y)

    pairs, found = jaccard.links(docs)
    least = {}
    for i, x in usable:
        least[x] = min(i, least.get(x, i))
    sets = list(least)
    want = {frozenset((least[x], least[y])) for j, x in enumerate(sets) for y in sets[j + 1:] if linked(x, y)}
    got = [(r["id_a"], r["id_b"]) for r in pairs.collect()]
    assert len(got) == len(want) and {frozenset(p) for p in got} == want
    rows = found.collect()
    assert len({r["class"] for r in rows if r["class"] is not None}) == len(sets)
    count = [(i, len(x), sum(linked(x, y) for _, y in usable) - 1) for i, x in usable]
    count += [(i, len(shingle_set(t)), 0) for i, t in data if i is None or not shingle_set(t)]
    assert sorted([(r["doc_id"], r["n_shingles"], r["n_links"]) for r in rows], key=key) == sorted(count, key=key)
