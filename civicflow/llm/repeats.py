"""Substring dedup: repeated windows of ``WINDOW`` words, found in prefix-partitioned suffix trees.

A word is removed when a window of ``WINDOW`` consecutive words of its
document covers it whose word sequence also starts anywhere else, the same
document included.

1. Documents with the same word sequence collapse to one class; a class of
   two documents or more is repeated as a whole.
2. Every suffix of at least ``WINDOW`` words goes to the group of a prefix of
   ``DEPTH`` words: of the DEPTH-word prefixes that start within its window
   the one with the least hash.  Equal windows have the same, and
   neighbouring suffixes mostly share one, so a run of suffixes travels as
   one stretch of text.  Prefixes that occur once in all documents hold no
   repeat and end here: only their counts are shuffled.
3. Groups of more than ``HOT`` words are split by longer and longer prefixes of
   their suffixes (``LONGER``), each only as far as it must be to fit.  A group
   that is still too large at the whole window is a single node at depth
   WINDOW: whatever its size, its leaves need only be counted.
4. All other groups, of any prefix length, are read in order of their prefix,
   as many at a time as fit ``TREE_BYTES``; each batch of groups is one suffix
   tree, built as sorted ranks of doubling depth (1, 2, 4, ... words).  Its
   nodes are the prefixes of 1, 2, 4, ... and of WINDOW words that suffixes
   share; deeper ones are not told apart, as no result depends on them: a
   suffix is a leaf below some node of WINDOW words or more exactly if its
   window occurs again.  The windows of those leaves, joined where they touch,
   are the maximal repeated stretches of each document.

Words and windows are compared as 64-bit hashes.

Cases: a null or empty text has no words and stays; a text shorter than a
window keeps all its words; repeated rows (of id and text) are documents that
repeat each other; null ids are documents like others; an empty table gives no
rows; input columns with the names of result columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow import session
from civicflow.llm.stages import written
from civicflow.llm.textmap import NOT_SPACE, Chunk, Words, emit_rows, map_text, mix, others, per_row, quoted, windows

WINDOW = 35
DEPTH = 16
HOT = 400_000
# prefix lengths that split groups beyond HOT words, before the whole window
LONGER = (20, 24, 28, 32)
TREE_BYTES = 8 << 20


def class_keys(words: Words, hashes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's word sequence."""
    place = np.arange(len(hashes)) - words.first[words.row] if len(hashes) else np.zeros(0, np.int64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + mix(place.astype(np.uint64) + np.uint64(1))), out=sums[1:])
    total = sums[words.first[1:]] - sums[words.first[:-1]]
    return mix(total + words.count.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def prefix_runs(words: Words, hashes: np.ndarray, window: int = WINDOW, depth: int = DEPTH):
    """Runs of suffixes that share a prefix group: (first suffix, suffixes, hash of the prefix, its first and last place).

    In a run that repeats one prefix (the same word over and over) the places
    differ; all its suffixes are still one stretch.
    """
    n = len(hashes)
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    if n < window:
        return none
    same_row = np.zeros(n, np.int64)  # prefixes across rows are computed too; no suffix looks at them
    _, h = windows(hashes, same_row, depth)
    m = n - window + 1
    # leftmost least hash of the window - depth + 1 prefixes from each position, by doubling
    span = window - depth + 1
    best, width = np.arange(len(h)), 1
    while 2 * width <= span:
        a, b = best[:len(best) - width], best[width:]
        best = np.where(h[a] <= h[b], a, b)
        width *= 2
    if width < span:
        a, b = best[:m], best[span - width:span - width + m]
        best = np.where(h[a] <= h[b], a, b)
    best = best[:m]
    valid = words.row[:m] == words.row[window - 1:]
    at = np.flatnonzero(valid)
    if not len(at):
        return none
    anchor = best[at]
    sig = h[anchor]
    new = np.ones(len(at), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], last - first + 1, sig[first], anchor[first], anchor[last]


def deep_nodes(words: Words, hashes: np.ndarray, suffixes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of the suffixes are leaves below an internal node at depth ``window`` or deeper.

    The tree's levels at depth 1, 2, 4, ... are the ranks of all suffixes cut
    at that depth, each level from pairs of the one before; two overlapping
    ranks give the level at ``window``.
    """
    n = len(hashes)
    _, rank = np.unique(hashes, return_inverse=True)
    depth = 1
    while 2 * depth <= window:
        beyond = np.full(n, -1, np.int64)
        inside = words.row[:n - depth] == words.row[depth:]
        beyond[:n - depth][inside] = rank[depth:][inside]
        _, rank = np.unique(rank.astype(np.int64) * (n + 1) + beyond + 1, return_inverse=True)
        depth *= 2
    key = rank[suffixes].astype(np.int64) * (n + 1) + rank[suffixes + window - depth]
    order = np.argsort(key, kind="stable")
    twin = np.zeros(len(key), bool)
    same = key[order][1:] == key[order][:-1]
    twin[order[1:]] |= same
    twin[order[:-1]] |= same
    return twin


def _stretches(k: np.ndarray, start: np.ndarray, window: int) -> list[np.ndarray]:
    """Flagged suffixes as stretches (k, first word, one past the last word); neighbours joined."""
    order = np.lexsort((start, k))
    k, start = k[order], start[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(k)) - 1
    return [k[first], start[first], start[last] + window] if len(k) else [k, start, start]


_LONG = T.LongType()


def _schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType() if n == "t" else _LONG) for n in names])


def _occurrence(k: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(k + mix(start.astype(np.uint64) + np.uint64(0x9E37)))


def _trees(spans: DataFrame, window: int) -> DataFrame:
    """(k, s, e) of the repeats in the groups of ``spans`` (sig, k, start, cnt, t), which come sorted by sig."""
    schema = _schema("k", "s", "e")

    def build(table: pa.Table) -> pa.RecordBatch:
        column = table.column("t").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
        chunk = Chunk(column)
        words = Words(chunk.data, chunk.off, NOT_SPACE)
        cnt = table.column("cnt").to_numpy()
        owner = np.repeat(np.arange(len(cnt)), cnt)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(cnt) - cnt, cnt)
        twin = deep_nodes(words, words.hashes(), words.first[owner] + offset, window)
        start = table.column("start").to_numpy()[owner] + offset
        found = _stretches(table.column("k").to_numpy()[owner][twin], start[twin], window)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["k", "s", "e"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < TREE_BYTES:
                continue
            table = pa.Table.from_batches(held)
            sig = table.column("sig").to_numpy()
            cut = int(np.searchsorted(sig, sig[-1]))  # the last group may go on
            if cut:
                yield build(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
            held, size = rest.to_batches(), rest.nbytes
        if held:
            table = pa.Table.from_batches(held)
            if table.num_rows:
                yield build(table)

    return spans.select("sig", "k", "start", "cnt", "t").mapInArrow(run, schema)


def _class_of(chunk: Chunk) -> tuple[Words, np.ndarray, np.ndarray]:
    words = Words(chunk.data, chunk.off, NOT_SPACE)
    hashes = words.hashes()
    return words, hashes, class_keys(words, hashes)


def _runs_once(chunk: Chunk, window: int):
    """Prefix runs of the chunk's classes, one row of each: prefix, class, first suffix, suffixes, places of the prefix."""
    words, hashes, key = _class_of(chunk)
    first, cnt, sig, low, high = prefix_runs(words, hashes, window)
    row = words.row[first]
    _, one = np.unique(key, return_index=True)
    alone = np.zeros(chunk.n, bool)
    alone[one] = True
    take = alone[row]
    first, cnt, sig, row, low, high = (x[take] for x in (first, cnt, sig, row, low, high))
    start = words.first[row]
    return sig, key[row], first - start, cnt, low - start, high - start


def repeated_stretches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(k, found): the repeated stretches (s, e) of every class of documents that has one, in words."""
    session.configure(docs.sparkSession)
    source = docs.select(quoted(doc_id).alias("id"), quoted(text).cast("string").alias("text")).filter("text is not null")
    meta = written(map_text(source, "text", [T.StructField("n", _LONG), T.StructField("k", _LONG)],
                            lambda chunk, batch: (lambda w, h, k: {"n": w.count, "k": k.view(np.int64)})(*_class_of(chunk)), keep=["id"])
                   .filter(f"n >= {window}"), "classes")
    classes = meta.groupBy("k").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.count("*").alias("copies"))

    def counted(chunk: Chunk, batch: pa.RecordBatch) -> list:
        sig, k, _, _, low, high = _runs_once(chunk, window)
        # where a run holds its prefix more than once, two of the places show it
        more = high > low
        return [pa.array(np.concatenate([sig, sig[more]]).view(np.int64)),
                pa.array(np.concatenate([_occurrence(k, low), _occurrence(k[more], high[more])]).view(np.int64))]

    def placed(chunk: Chunk, batch: pa.RecordBatch) -> list:
        sig, k, start, cnt, _, _ = _runs_once(chunk, window)
        return [pa.array(sig.view(np.int64)), pa.array(k.view(np.int64)), pa.array(start, pa.int64()), pa.array(cnt, pa.int64())]

    shared = written(emit_rows(source, "text", [], _schema("sig", "o"), counted).groupBy("sig")
                     .agg(F.min("o").alias("lo"), F.max("o").alias("hi")).filter("lo <> hi").select("sig"), "shared-prefixes")
    runs = emit_rows(source, "text", [], _schema("sig", "k", "start", "cnt"), placed).join(shared, "sig", "left_semi")
    # the runs of one class: bounded by its text; copies in other chunks gave the same runs again
    runs = written(runs.groupBy("k").agg(F.collect_set(F.struct("start", "cnt", "sig")).alias("runs")), "runs")
    wanted = runs.join(classes.select("k", "rep"), "k").select(F.col("rep").alias("id"), "k", "runs")
    keyed = map_text(source, "text", [T.StructField("key", _LONG)],
                     lambda chunk, batch: {"key": _class_of(chunk)[2].view(np.int64)}, keep=["id", "text"])
    texts = keyed.join(wanted, keyed["id"].eqNullSafe(wanted["id"]) & (keyed["key"] == wanted["k"])).select("k", "runs", "text")
    if not meta.groupBy("id", "k").count().filter("count > 1").isEmpty():
        texts = texts.dropDuplicates(["k"])

    def cut(chunk: Chunk, batch: pa.RecordBatch) -> list:
        words = Words(chunk.data, chunk.off, NOT_SPACE)
        found = batch.column(2)
        flat = found.flatten()
        row = np.repeat(np.arange(chunk.n), np.diff(np.asarray(found.offsets)))
        start, cnt = np.asarray(flat.field("start")), np.asarray(flat.field("cnt"))
        lo = words.start[words.first[row] + start].tolist()
        hi = words.end[words.first[row] + start + cnt + window - 2].tolist()
        raw = chunk.data.tobytes()
        return [flat.field("sig"), batch.column(1).take(pa.array(row)), flat.field("start"), flat.field("cnt"),
                pa.array([raw[a:b].decode() for a, b in zip(lo, hi)], pa.string())]

    spans = written(emit_rows(texts, "text", ["k", "runs"], _schema("sig", "k", "start", "cnt", "t"), cut), "stretches")
    words = F.sum(F.col("cnt") + window)
    hot = written(spans.groupBy("sig").agg(words.alias("c")).filter(F.col("c") > HOT).select("sig"), "hot-prefixes")
    small = spans.join(hot, "sig", "left_anti").repartition("sig").sortWithinPartitions("sig")
    found = [_trees(small, window)]
    if not hot.isEmpty():
        found += _longer_prefixes(spans.join(hot, "sig", "left_semi"), window)
    found.append(classes.filter("copies > 1").select("k", F.lit(0).cast("long").alias("s"), F.col("n").alias("e")))
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    # the stretches of one class: bounded by its text
    return written(every.groupBy("k").agg(F.collect_list(F.struct("s", "e")).alias("found")), "repeats")


def _longer_prefixes(spans: DataFrame, window: int) -> list[DataFrame]:
    """(k, s, e) of the repeats in oversize groups: their suffixes split by more and more of their words.

    A suffix goes to the first of ``LONGER`` prefixes whose group fits, and
    those groups become trees like all others.  What is left shares whole
    windows: such a group is one node at depth ``window``, and all its
    suffixes, if more than one, are leaves below it.
    """
    depths = [d for d in LONGER if d < window] + [window]
    names = [f"p{d}" for d in depths]

    def prefixes(chunk: Chunk, batch: pa.RecordBatch) -> list:
        words = Words(chunk.data, chunk.off, NOT_SPACE)
        hashes = words.hashes()
        at, _ = windows(hashes, words.row, window)
        row = words.row[at]
        whole = np.zeros(len(hashes), np.int64)  # each prefix lies in its window, and so in its row
        found = [windows(hashes, whole, d)[1][at].view(np.int64) for d in depths]
        return [batch.column(1).take(pa.array(row)), batch.column(2).take(pa.array(row)),
                pa.array(np.asarray(batch.column(2))[row] + at - words.first[row], pa.int64()), *map(pa.array, found)]

    rest = written(emit_rows(spans, "t", ["k", "start"], _schema("k", "start", "s", *names), prefixes), "prefixes")
    fits: DataFrame | None = None
    for name in names[:-1]:
        big = written(rest.groupBy(name).agg((F.count("*") * window).alias("c")).filter(F.col("c") > HOT).select(name), "big-prefixes")
        part = rest.join(big, name, "left_anti").select("k", "start", F.struct("s", F.col(name).alias("p")).alias("x"))
        fits = part if fits is None else fits.unionByName(part)
        rest = rest.join(big, name, "left_semi")
    last = names[-1]
    o = F.xxhash64("k", "s")
    twins = rest.groupBy(last).agg(F.min(o).alias("lo"), F.max(o).alias("hi")).filter("lo <> hi").select(last)
    found = [rest.join(twins, last, "left_semi").select("k", "s", (F.col("s") + window).alias("e"))]
    if fits is not None:
        # the suffixes of one stretch: bounded by its text
        wanted = fits.groupBy("k", "start").agg(F.collect_list("x").alias("x"))

        def cut(chunk: Chunk, batch: pa.RecordBatch) -> list:
            words = Words(chunk.data, chunk.off, NOT_SPACE)
            flat = batch.column(3).flatten()
            row = np.repeat(np.arange(chunk.n), np.diff(np.asarray(batch.column(3).offsets)))
            s = np.asarray(flat.field("s"))
            at = words.first[row] + s - np.asarray(batch.column(2))[row]
            raw = chunk.data.tobytes()
            return [flat.field("p"), batch.column(1).take(pa.array(row)), flat.field("s"), pa.array(np.ones(len(s), np.int64)),
                    pa.array([raw[a:b].decode() for a, b in zip(words.start[at].tolist(), words.end[at + window - 1].tolist())], pa.string())]

        texts = spans.select("k", "start", "t").join(wanted, ["k", "start"]).select("k", "start", "x", "t")
        small = emit_rows(texts, "t", ["k", "start", "x"], _schema("sig", "k", "start", "cnt", "t"), cut)
        found.append(_trees(small.repartition("sig").sortWithinPartitions("sig"), window))
    return found


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   keep: list[str] | None = None) -> DataFrame:
    """Adds n_words, n_removed and kept_text: the words that stay, joined by one space (of a null text: empty)."""
    names = ["n_words", "n_removed", "kept_text"]
    carried = others(list(docs.columns if keep is None else keep), names)
    found = repeated_stretches(docs, doc_id, text, window)
    source = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(carried)], quoted(text).cast("string").alias("text"))
    keyed = map_text(source, "text", [T.StructField("k", _LONG)],
                     lambda chunk, batch: {"k": _class_of(chunk)[2].view(np.int64)})
    fields = [T.StructField("n_words", _LONG), T.StructField("n_removed", _LONG), T.StructField("kept_text", T.StringType())]
    places = [f"c{i}" for i in range(len(carried))]

    def run(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        words = Words(chunk.data, chunk.off, NOT_SPACE)
        column = batch.column(len(places) + 1).fill_null([])
        flat = column.flatten()
        row = np.repeat(np.arange(chunk.n), np.diff(np.asarray(column.offsets)))
        delta = np.zeros(len(words.row) + 1, np.int64)
        np.add.at(delta, words.first[row] + np.asarray(flat.field("s")), 1)
        np.add.at(delta, words.first[row] + np.asarray(flat.field("e")), -1)
        gone = np.cumsum(delta[:-1]) > 0
        raw = chunk.data.tobytes()
        removed = per_row(gone, words.first)
        kept = []
        for r in range(chunk.n):
            parts = raw[chunk.off[r]:chunk.off[r + 1]].split()
            if removed[r]:
                parts = [p for p, g in zip(parts, gone[words.first[r]:words.first[r + 1]].tolist()) if not g]
            kept.append(b" ".join(parts).decode())
        return {"n_words": words.count, "n_removed": removed, "kept_text": kept}

    with_found = keyed.join(found, "k", "left").select(*places, "text", "found")
    made = map_text(with_found, "text", fields, run, keep=places + ["found"]).drop("found")
    return made.select(*[F.col(p).alias(c) for p, c in zip(places, carried)], *names)
