"""Small inputs with the hard cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def sentence(rng, n, words="the of and to in is that it was for on with as by at from".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "s", "ed", "ing", "ly", str(rng.randint(0, 9))]) for _ in range(n))


def rows(seed=7):
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    out = []
    for i in range(40):
        text = sentence(rng, rng.randint(1, 160))
        if i % 5 == 0:
            text = f"{sentence(rng, 20)} {passage} {sentence(rng, 30)}"
        if i % 7 == 0:
            text = text.upper() + " " + text
        out.append((i, text, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], len(text)))
    base = sentence(rng, 120)
    for j in range(12):  # near copies, one word changed in each, and plain copies
        words = base.split()
        words[j * 9] = f"changed{j}"
        out.append((100 + j, " ".join(words), "en", "a", 0))
    for j in range(6):
        out.append((200 + j, base, "en", "a", 0))
    out += [(300, None, None, None, None), (301, "", "en", None, 0), (302, " \t\n", None, "b", 3), (303, "one two", "en", "b", 7),
            (304, "one  two", "en", "b", 8), (305, "word " * 200, "en", "b", 1000), (306, "x" * 50_000, "en", "b", 50_000),
            (307, sentence(rng, 30_000), "en", "a", 0), (308, "été ß 中文 👩‍👩‍👧 naïve x\u0085y\x1cz", "fr", "b", 9),
            (309, passage, "fr", "b", 9), (309, passage, "fr", "b", 9), (None, base, "en", "a", 1), (None, "lone text of nobody", None, None, 1)]
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCS).repartition(4)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    """Words split at ASCII white space, as bytes."""
    return (text or "").encode().split()
