"""Plain versions, one text at a time, of operators that neither SQL nor a library checks: votes, language scores, surrogates."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from cases import rows, words
from civicflow.llm import language, surrogates, weak_quality
from civicflow.llm.textmap import NOT_SPACE, Chunk, Words

TEXTS = [t for _, t, *_ in rows()] + ["$$$ %%% *** a##b", "THE CAT SAT ON THE MAT AND SAT AGAIN " * 4, "a a a a a a a a a a a a b", "1234 5678 " * 20,
                                      "internationalisation " * 15, "l'été déjà où ça", "ok", "x" * 60]


def plain_votes(text):
    """The ten labellers from their definitions."""
    text = text or ""
    w = [x.decode() for x in words(text)]
    n, chars = max(len(w), 1), max(sum(map(len, w)), 1)
    raw = text.encode()
    triples = defaultdict(list)
    for i in range(len(w) - 2):
        triples[tuple(w[i:i + 3])].append(i)
    repeated = {p + o for at in triples.values() if len(at) > 1 for p in at for o in range(3)}
    upper, lower = sum(0x41 <= b <= 0x5A for b in raw), sum(0x61 <= b <= 0x7A for b in raw)
    beyond = sum(b >= 0xC0 for b in raw)
    letter = [[b for b in x.encode() if chr(b).isalnum() and b < 0x80 or b >= 0x80] for x in w]
    marks = [[b for b in x.encode() if 0x21 <= b < 0x7F and not chr(b).isalnum()] for x in w]
    symbols, repeats = sum(text.count(c) for c in "#*$%&|<>") / chars, len(repeated) / n
    capitals, mean, letters = upper / max(upper + lower, 1), chars / n, (upper + lower + beyond) / chars
    variety = len(set(w)) / math.sqrt(n)
    stutter = sum(a == b for a, b in zip(w, w[1:])) / n
    bare, marked = sum(not x for x in letter) / n, sum(len(x) >= 2 for x in marks) / n
    good = [len(w) >= 50, symbols < 0.005, repeats < 0.2, capitals < 0.1 and lower > 0, 3.5 < mean < 8.5 and w, letters > 0.9, variety > 4,
            stutter < 0.05 and len(w) >= 12, bare < 0.02 and w, marked < 0.02 and w]
    bad = [len(w) < 2, symbols > 0.04, repeats > 0.5, capitals > 0.4, mean < 2.2 or mean > 13 or not w, letters < 0.75,
           variety < 2.5 and len(w) >= 12, stutter > 0.25, bare > 0.15, marked > 0.2]
    return [weak_quality.BAD if b else weak_quality.GOOD if g else weak_quality.NONE for g, b in zip(good, bad)]


def test_votes():
    chunk = Chunk(pa.array(TEXTS, pa.string()))
    got = weak_quality.votes(chunk, Words(chunk.data, chunk.off, NOT_SPACE))
    for text, row in zip(TEXTS, got.tolist()):
        assert row == plain_votes(text), (text or "")[:80]


def test_estimation_step_by_step():
    """The same posteriors as expectation-maximisation over single documents."""
    rng = np.random.default_rng(4)
    n, k = 300, len(weak_quality.LABELLERS)
    says = rng.choice([0, 1, 2], p=[0.15, 0.35, 0.5], size=(n, k))
    patterns, of, counts = np.unique(says @ 3 ** np.arange(k), return_inverse=True, return_counts=True)
    good, table, prior = weak_quality.estimate(patterns, counts.astype(float), rounds=20, specific=None)
    p = [1 / (1 + math.exp(-(sum(v == 2 for v in row) - 2 * sum(v == 0 for v in row)))) for row in says.tolist()]
    for _ in range(20):
        tables = {}
        for c in (0, 1):
            weight = [x if c else 1 - x for x in p]
            tables[c] = []
            for j in range(k):
                votes = {v: 0.5 + sum(g for g, row in zip(weight, says.tolist()) if row[j] == v) for v in (0, 2)}
                tables[c].append({v: x / sum(votes.values()) for v, x in votes.items()})
        share = {1: (sum(p) + 1) / (n + 2)}
        share[0] = (n - sum(p) + 1) / (n + 2)
        for i, row in enumerate(says.tolist()):
            ll = {c: math.log(share[c]) + sum(math.log(tables[c][j][v]) for j, v in enumerate(row) if v != 1) for c in (0, 1)}
            p[i] = 1 / (1 + math.exp(min(max(ll[0] - ll[1], -30), 30)))
    assert np.abs(good[of] - np.array(p)).max() < 1e-9 and abs(prior - share[1]) < 1e-9


def letter_runs(text):
    """Lower-cased letters with one blank for every stretch of anything else, also at both ends."""
    out = []
    for c in " " + (text or "").lower() + " ":
        if c.isalpha():
            out.append(c)
        elif not out or out[-1] != " ":
            out.append(" ")
    return "".join(out)


def test_language_scores(spark):
    """The corrected share of n-grams, counted with sets in place of filters; the filters may only add false hits."""
    docs = [(i, f"{a} {b} {c}", lang) for i, (lang, a, b, c) in enumerate(
        [("en", "the house", "and garden", f"of number {i}") for i in range(25)] + [("de", "das haus", "und der garten", f"von nummer {i}") for i in range(25)])]
    model = language.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    texts = ["the garden of the house", "der garten und das haus", "GARTEN and HAUS 12", "", None, "123 !", "zzz qqq xxyyzz", "é中ß"]
    held = {"en": [t for _, t, lang in docs if lang == "en"], "de": [t for _, t, lang in docs if lang == "de"]}
    known = {}
    for lang, members in held.items():
        counted = defaultdict(int)
        for t in members:
            s = letter_runs(t)
            for g in {s[i:i + n] for n in language.NGRAMS for i in range(len(s) - n + 1)}:
                counted[g] += 1
        known[lang] = {g for g, c in counted.items() if c >= language.MIN_DOCS}
    got = language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        s = letter_runs(r["text"])
        grams = [s[i:i + n] for n in language.NGRAMS for i in range(len(s) - n + 1)]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        share = {lang: sum(g in known[lang] for g in grams) / len(grams) for lang in known}
        assert abs(r["score"] - max(share.values())) < 0.01
        if max(share.values()) > 0:
            assert r["lang_pred"] == max(share, key=share.get)


def test_planted_entities(spark):
    """Texts made of known parts: what is no entity stays, each entity becomes one of its kind and format, and one
    entity has one surrogate everywhere, two entities two."""
    rng = random.Random(9)
    plain = ["call me", "at 10:30 on the 5th,", "version 1.2.3 -", "it costs 12 euros;", "see page 117.", "über alles", "(all of it)", "no 4711 here", "\n", "中文"]

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def mail():
        return f"{rng.choice('abcdef')}{digits(2)}.{rng.choice(['li', 'wang', 'ng'])}@{rng.choice(['corp', 'mail7'])}.{rng.choice(['com', 'co.uk'])}"

    make = {"mail": mail, "ip": lambda: f"{rng.randint(1, 223)}.{rng.randint(0, 255)}.{rng.randint(0, 9)}.{rng.randint(1, 254)}",
            "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}", "card": lambda: f"4{digits(15)}", "phone": lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}"}
    shape = {"mail": r"[a-z]\d\d\.[a-z]+@[a-z0-9.]+", "ip": r"\d{1,3}(\.\d{1,3}){3}", "ssn": r"\d{3}-\d{2}-\d{4}", "card": r"4\d{15}", "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}"}
    pool = {kind: [fn() for _ in range(12)] for kind, fn in make.items()}
    texts = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 12)):
            kind = rng.choice([None, None, *make])
            parts.append((kind, rng.choice(plain) if kind is None else rng.choice(pool[kind])))
        texts.append(parts)
    frame = spark.createDataFrame([(i, " ".join(p for _, p in parts)) for i, parts in enumerate(texts)], "doc_id long, text string").repartition(3)
    there, back = {}, {}
    for r in surrogates.replace(frame, "key").collect():
        parts = texts[r["doc_id"]]
        pattern = " ".join(f"(?P<e{i}>{shape[kind]})" if kind else re.escape(p) for i, (kind, p) in enumerate(parts))
        m = re.fullmatch(pattern, r["text"], re.S)
        assert m, (r["text"], parts)
        found = [(kind, p) for kind, p in parts if kind]
        assert r["n_entities"] == len(found)
        for (kind, old), new in zip(found, m.groupdict().values()):
            assert kind in ("ip", "mail") or len(new) == len(old)
            assert new != old and there.setdefault((kind, old), new) == new and back.setdefault((kind, new), old) == old
    domains = defaultdict(set)
    for (kind, old), new in there.items():
        if kind == "mail":
            domains[old.split("@")[1]].add(new.split("@")[1])
    assert len(there) > 40 and all(len(x) == 1 for x in domains.values())
    assert not {new for _, new in back} & {old for _, old in there}
