"""A training corpus from documents, in five stages.

language ID (undetermined or unlikely text goes), near duplicates (one
document of each group stays), benchmark decontamination (documents that hold
a benchmark window go), PII surrogates, and BPE token ids.

``run`` writes each stage's result as Parquet under ``spark.checkpoint.dir``
and reads it again as the next one's documents.

Cases: null and empty texts, and texts without a letter, have no language and
go in the first stage; documents without an id link with no other; an empty
table gives an empty result; further columns of the documents pass through
to the last stage, whatever their names: where one of them is called as a
column that the last stage adds, the added one is called ``token_`` and its name.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm import bpe, decontaminate, jaccard, language, surrogates
from civicflow.llm.stages import written
from civicflow.llm.textmap import quoted

# least share of a text's n-grams that its language must contain
MIN_LANGUAGE_SCORE = 0.3
# a deployment passes its own secret
SURROGATE_KEY = "surrogates of the corpus pipeline"
VOCABULARY = "byte_bpe_50k.json"


def numbered(docs: DataFrame) -> tuple[DataFrame, str, list[Column]]:
    """The documents with numbers for column names, that no operator's own columns clash with; the text's; the names put back."""
    names = docs.columns
    return (docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(names)]), f"c{names.index('text')}",
            [F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents with a language (but the held-out fold) and keeps those with a likely one."""
    model = language.train(docs.filter(~language.held_out("doc_id")))
    plain, text, back = numbered(docs)
    found = language.predict(plain, model, text)
    return found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near duplicates."""
    return jaccard.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    plain, text, back = numbered(docs)
    found = decontaminate.decontaminate(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text)
    return found.filter("n_hit = 0").select(*back)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; n_chars follows the text."""
    plain, text, back = numbered(docs)
    done = surrogates.replace(plain, SURROGATE_KEY, text)
    return done.select(*[F.char_length(text).cast("long").alias(c) if c == "n_chars" else column
                         for c, column in zip(docs.columns, back)])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether the ids decode to the text again."""
    path = public_tokenizers.path(VOCABULARY)
    plain, text, back = numbered(docs)
    both = bpe.encode(plain, path, text, decoded=True)
    made = {"ids": F.col("ids"), "n_tokens": F.size("ids").cast("long"),
            "round_trip": F.col("decoded") == F.coalesce(F.col(text), F.lit(""))}
    taken = {c.lower() for c in docs.columns}
    for name, column in made.items():
        while name in taken:
            name = f"token_{name}"
        back.append(column.alias(name))
    return both.select(*back)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("tokens", tokens),
]

# trained and iterative stages: SQL cannot express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
