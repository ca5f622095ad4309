"""Ranked lexical search: summed accumulators from short lists, then documents at a time over them and the long lists.

Terms are runs of ASCII digits, letters and any characters beyond ASCII, A-Z
in lower case.  A term's weight falls with the documents that hold it, a
document's share of it grows with its occurrences and falls with the
document's length; both are whole numbers (``weights``, ``_parts``), so
scores are exact and do not depend on the order of work.

* ``postings`` makes one narrow pass over the documents and writes blocks:
  the ids and lengths of up to a few thousand documents, and for each term of the
  queries the list of those that hold it with its occurrences there.  Blocks
  also give N, the total length and each term's document count.
* A task searches its blocks one after the other and keeps the best of each
  query.  In a block, a query's shortest lists are summed into one list of
  accumulators (term at a time) as long as they are a small share of the
  block's documents.  That list has a bound, its largest sum, as each long
  list has one, its weight times its largest part.
* The block is then walked in windows of documents.  Iterators whose bounds
  together stay below the least score worth keeping cannot bring up a
  document alone: they are only probed, by binary search, for documents that
  the other iterators name, the largest bound first, and a document is left
  as soon as what remains cannot lift it to that score.
* The best of each task meet in two steps, by query and a hash, then by query.

Queries go out in groups of about ``QUERY_TERMS`` terms, the bound of a
broadcast; each group makes a pass.  Terms are compared as 64-bit hashes.

Cases: null and empty texts have no terms, do not count and are never found;
an item without terms finds nothing, nor do terms that no document holds;
repeated documents are ranked each; rows of items that share an id are one
item with the terms of all; a null item id is an item; null document ids come
last among equal scores; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.stages import shared, written
from civicflow.llm.textmap import ALNUM, BATCH_ROWS, LOWER, Chunk, Words, chunks, emit_rows, quoted

TOP = 50
# terms of queries in one broadcast, about
QUERY_TERMS = 200_000
# documents and postings of a block, at most (a document more than fits makes a block of its own)
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 18
# documents of a window, and the share of a block that accumulators may hold
WINDOW = 1024
SHORT_SHARE = 8
# first step of the meeting of the best
PARTS = 64
_NO_ID = np.iinfo(np.int64).max

_BLOCK = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
                       T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())),
                       T.StructField("docs", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
_BEST = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("score", T.LongType()), T.StructField("doc_id", T.LongType())])


def _words(chunk: Chunk) -> Words:
    return Words(LOWER[chunk.data], chunk.off, ALNUM)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of each item, as hashes."""
    def run(chunk: Chunk, batch: pa.RecordBatch) -> list:
        w = _words(chunk)
        return [batch.column(1).take(pa.array(w.row)), pa.array(w.hashes().view(np.int64))]

    keyed = items.select(quoted(item_id).alias("item_id"), quoted(text).alias("text"))
    schema = T.StructType([T.StructField("item_id", keyed.schema["item_id"].dataType), T.StructField("term", T.LongType())])
    return emit_rows(keyed, "text", ["item_id"], schema, run).distinct()


class _Blocks:
    """Collects postings of chunks and cuts them into blocks."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self._clear()

    def _clear(self) -> None:
        self.ids: list = []
        self.lengths: list = []
        self.found: list = []
        self.docs = self.postings = 0

    def add(self, ids: pa.Array, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        w = _words(chunk)
        h = w.hashes().view(np.int64)
        at = np.minimum(np.searchsorted(self.terms, h), max(len(self.terms) - 1, 0))
        hit = self.terms[at] == h if len(self.terms) else np.zeros(len(h), bool)
        # documents with terms only, numbered in the order of the block
        has = np.flatnonzero(w.count)
        number = np.cumsum(w.count > 0) - 1
        key, count = np.unique(at[hit] * np.int64(max(chunk.n, 1)) + number[w.row[hit]], return_counts=True)
        if self.docs and (self.docs + len(has) > BLOCK_DOCS or self.postings + len(key) > BLOCK_POSTINGS):
            yield self.block()
        self.ids.append(ids.take(pa.array(has)))
        self.lengths.append(w.count[has])
        self.found.append((key // max(chunk.n, 1), key % max(chunk.n, 1) + self.docs, count))
        self.docs += len(has)
        self.postings += len(key)

    def block(self) -> pa.RecordBatch:
        term, doc, count = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((doc, term))
        held, sizes = np.unique(term, return_counts=True)
        columns = [pa.concat_arrays(self.ids), pa.array(np.concatenate(self.lengths), pa.int64()), pa.array(self.terms[held], pa.int64()),
                   pa.array(sizes, pa.int64()), pa.array(doc[order], pa.int32()), pa.array(count[order], pa.int32())]
        self._clear()
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], names=_BLOCK.names)


def postings(docs: DataFrame, terms: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents with the lists of the given terms (sorted hashes); one narrow pass over the documents."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    wanted = shared(spark, terms)

    def run(batches):
        blocks = _Blocks(wanted())
        for batch in batches:
            for lo, hi in chunks(batch.column(0)):
                part = batch.slice(lo, hi - lo)
                yield from blocks.add(part.column(1), Chunk(part.column(0)))
        if blocks.docs:
            yield blocks.block()

    return docs.select(quoted(text).cast("string").alias("t"), quoted(doc_id).cast("long").alias("d")).mapInArrow(run, _BLOCK)


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1)))"""
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)


def _parts(counts: np.ndarray, lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """1e9 tf div (1000 tf + 20 m) with m = 50 + 50 n N div L; lengths: that of each posting's document."""
    if int(lengths.max(initial=0)) * 50 * n < 1 << 63:
        m = 50 + 50 * lengths * n // total
    else:
        m = 50 + (50 * lengths.astype(object) * n // total).astype(np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


@dataclass
class Best:
    """The best documents of a query: scores falling, then ids rising, null ids last."""

    top: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def least(self) -> int:
        """What a document must reach: the last kept score once there are enough (equal scores are told apart by id)."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def take(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        order = np.lexsort((ids, null, -scores))[:self.top]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: (documents, summed scores) of the lists (documents, scores)."""
    docs = np.concatenate([d for d, _ in lists])
    found, at = np.unique(docs, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, at, np.concatenate([s for _, s in lists]))
    return found, sums


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, best: Best, ids: np.ndarray, null: np.ndarray) -> int:
    """Brings the documents of a block that belong there into ``best``; returns the number of documents scored.

    ``lists``: (documents, scores) of each term of the query, documents rising.
    """
    lists = sorted(lists, key=lambda x: len(x[0]))
    room = n_docs // SHORT_SHARE
    short = 0
    for d, _ in lists:
        room -= len(d)
        if room < 0:
            break
        short += 1
    # iterators by falling bound: the accumulators are one of them
    iterators = ([accumulate(lists[:short])] if short else []) + lists[short:]
    iterators = sorted(((int(s.max()), d, s) for d, s in iterators), key=lambda x: -x[0])
    # what an iterator and all after it can give
    rest = np.cumsum([b for b, _, _ in iterators][::-1])[::-1].tolist() + [0]
    at = [0] * len(iterators)
    scored = 0
    for lo in range(0, n_docs, WINDOW):
        least = best.least()
        if rest[0] < least:
            break
        # those from here on cannot reach the score without the ones before
        named = sum(r >= least for r in rest[:-1])
        score = np.zeros(WINDOW, np.int64)
        seen = np.zeros(WINDOW, bool)
        for i in range(named):
            _, d, s = iterators[i]
            end = int(np.searchsorted(d, lo + WINDOW))
            if end > at[i]:
                part = d[at[i]:end] - lo
                score[part] += s[at[i]:end]
                seen[part] = True
                at[i] = end
        found = np.flatnonzero(seen)
        total = score[found]
        for i in range(named, len(iterators)):
            alive = total + rest[i] >= least
            found, total = found[alive], total[alive]
            if not len(found):
                break
            _, d, s = iterators[i]
            place = np.searchsorted(d, found + lo)
            inside = place < len(d)
            inside[inside] = d[place[inside]] == found[inside] + lo
            total[inside] += s[place[inside]]
        scored += len(found)
        good = total >= least
        if good.any():
            rows = found[good] + lo
            best.take(total[good], ids[rows], null[rows])
    return scored


def _best_of_blocks(blocks: DataFrame, sent, top: int) -> DataFrame:
    """(query, score, doc_id): the best of each query in each task."""

    def run(batches):
        terms, weight, start, of_query, n, total = sent()
        best: dict[int, Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, held, sizes, docs, counts = (batch.column(i).slice(row, 1).flatten() for i in range(6))
                null = np.asarray(ids.is_null())
                ids = np.asarray(ids.fill_null(_NO_ID))
                lengths, held, sizes, docs, counts = (np.asarray(x) for x in (lengths, held, sizes, docs, counts))
                docs, counts = docs.astype(np.int64), counts.astype(np.int64)
                parts = _parts(counts, lengths[docs], n, total)
                end = np.cumsum(sizes)
                # place of each term of the queries among the lists of this block
                place = np.full(len(terms), -1)
                place[np.searchsorted(terms, held)] = np.arange(len(held))
                for query in range(len(start) - 1):
                    mine = of_query[start[query]:start[query + 1]]
                    lists = []
                    for t in mine[place[mine] >= 0].tolist():
                        if weight[t] > 0:
                            k = place[t]
                            cut = slice(end[k] - sizes[k], end[k])
                            lists.append((docs[cut], weight[t] * parts[cut]))
                    if lists:
                        search_block(lists, len(ids), best.setdefault(query, Best(top)), ids, null)
        for query, b in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.ids), query), pa.int32()), pa.array(b.scores, pa.int64()),
                                              pa.array(b.ids, pa.int64(), mask=b.null)], names=_BEST.names)

    spark = blocks.sparkSession
    # a batch is one block while this runs
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        return written(blocks.mapInArrow(run, _BEST), "search-best")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _first(df: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP, query_terms: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0."""
    spark = docs.sparkSession
    wanted = written(item_terms(items, item_id, item_text), "search-terms")
    kind = wanted.schema["item_id"].dataType
    groups = max(1, -(-wanted.count() // query_terms))
    found: DataFrame | None = None
    for group in range(groups):
        # an item lies in one group
        part = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group).toArrow() if groups > 1 else wanted.toArrow()
        if not part.num_rows:
            continue
        names = part.column("item_id").unique()
        code = np.asarray(pc.index_in(part.column("item_id"), value_set=names).combine_chunks())
        terms, of_row = np.unique(np.asarray(part.column("term"), np.int64), return_inverse=True)
        order = np.argsort(code, kind="stable")
        start = np.searchsorted(code[order], np.arange(len(names) + 1))
        blocks = written(postings(docs, terms, doc_id, text), "search-blocks")
        sums = blocks.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
        if not sums[0]:
            return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                                                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
        n, total = sums
        held = (blocks.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy(F.col("x.terms").alias("term"))
                .agg(F.sum("x.sizes").alias("df")).toArrow())
        df = np.zeros(len(terms), np.int64)
        df[np.searchsorted(terms, np.asarray(held.column("term")))] = np.asarray(held.column("df"))
        sent = shared(spark, (terms, weights(df, n), start, of_row[order], n, total))
        best = _best_of_blocks(blocks, sent, top)
        keyed = spark.createDataFrame(pa.table({"query": pa.array(range(len(names)), pa.int32()), "item_id": names}),
                                      T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", kind)]))
        merged = _first(best.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))), ["query", "part"], top)
        merged = _first(merged.select(*_BEST.names), ["query"], top)
        named = merged.join(F.broadcast(keyed), "query").select("item_id", "rank", "doc_id", "score")
        found = named if found is None else found.unionByName(named)
    if found is None:
        found = wanted.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return found
