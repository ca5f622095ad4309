"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams, scanned over document windows.

Normalisation: A-Z in lower case; words are runs of ASCII digits, letters
and any characters beyond ASCII.  A window is ``n`` consecutive words of a
benchmark item; an item with fewer words, but not none, is one window.

* The benchmark's windows are hashed in Spark, each window once with the items
  that hold it.  They go to the executors as flat arrays in blocks of about
  ``block_bytes``, the bound of what the driver, a broadcast and a worker hold
  of them; a larger benchmark is scanned block after block, with the result of
  a block written before the next one starts, so none is left out.
* Documents are scanned in one narrow pass per block: rolling hashes of word
  windows, a binary search in the block, then a comparison word by word with
  the benchmark's own words.

Cases: a null or empty text has no words and no hits; null or empty items
have no windows; repeated items count as they are (each item_id once per
document); null item ids are ignored; empty tables give no rows or no hits;
an input column with the name of a result column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.stages import shared, written
from civicflow.llm.textmap import ALNUM, LOWER, WORD_BASE, Chunk, Words, covered, emit_rows, map_text, mix, others, per_row, quoted, windows

WINDOW = 10
# bytes of windows, with words and item ids, in a broadcast
BLOCK_BYTES = 64 << 20
# bytes of a window in a block beside its words and ids: the hash and the places of both
WINDOW_BYTES = 32

_SIGN = np.uint64(1 << 63)
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _words(chunk: Chunk) -> Words:
    return Words(LOWER[chunk.data], chunk.off, ALNUM)


def item_windows(items: DataFrame, item_id: str, text: str, n: int = WINDOW) -> DataFrame:
    """(item_id, width, hash, words): every window of every item."""
    schema = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("width", T.IntegerType()),
                           T.StructField("hash", T.LongType()), T.StructField("words", T.StringType())])

    def run(chunk: Chunk, batch: pa.RecordBatch) -> list:
        w = _words(chunk)
        h = w.hashes()
        ids = batch.column(1).to_pylist()
        out: list[tuple] = []
        for width in range(1, n + 1):
            at, hashed = windows(h, w.row, width)
            if width < n:
                short = w.count[w.row[at]] == width
                at, hashed = at[short], hashed[short]
            for i, v in zip(at.tolist(), hashed.view(np.int64).tolist()):
                words = b" ".join(w.data[w.start[j]:w.end[j]].tobytes() for j in range(i, i + width))
                out.append((ids[w.row[i]], width, v, words.decode("utf-8", "replace")))
        cols = list(zip(*out)) if out else [[], [], [], []]
        return [pa.array(c, type=k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.string()))]

    keyed = items.select(quoted(item_id).cast("string").alias("item_id"), quoted(text).alias("text"))
    return emit_rows(keyed.filter("item_id is not null"), "text", ["item_id"], schema, run)


class Block:
    """A broadcast part of the benchmark as flat arrays: for each width the sorted window hashes, their words and their items."""

    def __init__(self, rows: pa.Table):
        self.widths = {}
        for width in sorted(set(rows.column("width").to_pylist())):
            part = rows.filter(pc.equal(rows.column("width"), width)).sort_by("key").combine_chunks()
            keys = part.column("key").to_numpy().astype(np.int64).view(np.uint64) ^ _SIGN
            texts = pa.concat_arrays(part.column("words").chunks).cast(pa.large_string())
            ids = pa.concat_arrays(part.column("items").chunks)
            # equal hashes of different windows stand side by side
            most = int(np.unique(keys, return_counts=True)[1].max())
            self.widths[width] = (keys, most, texts, ids)


def _scan(chunk: Chunk, block: Block) -> tuple[Words, list[np.ndarray], dict[int, set]]:
    """Word coverage by the block's windows and the items of each row."""
    w = _words(chunk)
    h = w.hashes()
    hit = np.zeros(len(h), bool)
    items: dict[int, set] = {}
    for width, (keys, most, texts, ids) in block.widths.items():
        all_at, hashed = windows(h, w.row, width)
        if not len(all_at):
            continue
        first = np.searchsorted(keys, hashed)
        for step in range(most):
            k = np.minimum(first + step, len(keys) - 1)
            found = np.flatnonzero((first + step < len(keys)) & (keys[k] == hashed))
            if not len(found):
                break
            at, k = all_at[found], k[found]
            # the words themselves, once for each window that a chunk contains: told apart by a second hash
            other = np.zeros(len(at), np.uint64)
            for j in range(width):
                other = mix(other * np.uint64(WORD_BASE) + h[at + j])
            _, one, of = np.unique(np.stack([k.view(np.uint64), other], axis=1), axis=0, return_index=True, return_inverse=True)
            right = np.array([b" ".join(w.data[w.start[j]:w.end[j]].tobytes() for j in range(at[i], at[i] + width)) == texts[int(k[i])].as_py().encode()
                              for i in one], bool)[of.ravel()]
            at, k = at[right], k[right]
            hit |= covered(at, width, len(h))
            pairs = np.unique(np.stack([w.row[at], k], axis=1), axis=0) if len(at) else np.zeros((0, 2), int)
            for row, key in pairs.tolist():
                items.setdefault(row, set()).update(ids[key].as_py())
    return w, hit, items


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", n: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  keep: list[str] | None = None) -> DataFrame:
    """Documents with what they share with the benchmark.

    Adds n_words, n_hit (words inside an occurrence of a window), items
    (sorted ids of the items with occurring windows), spans (hit stretches of
    the text, in code points, end exclusive) and clean_text (the text without
    those stretches; null stays null).
    """
    spark = docs.sparkSession
    # each window once; signed order of the key is the unsigned order of the hash
    source = written(item_windows(items, item_id, item_text, n).groupBy("width", "hash", "words")
                     .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
                     .withColumn("key", F.col("hash").bitwiseXOR(F.lit(-1 << 63).cast("long"))), "benchmark-windows")
    size = F.octet_length("words") + F.lit(WINDOW_BYTES) + F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x) + 4)
    total = source.agg(F.sum(size.cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    result = docs
    carried = list(docs.columns if keep is None else keep)
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
              T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", _SPANS),
              T.StructField("clean_text", T.StringType())]
    names = [f.name for f in fields]
    carried = others(carried, names + ["__source", "__items", "__hits"])
    result = docs.select(*[quoted(c) for c in carried], quoted(text).alias("__source"),
                         F.array().cast(T.ArrayType(T.StringType())).alias("__items"), F.array().cast(_SPANS).alias("__hits"))
    for b in range(blocks):
        # a block by the hash's remainder: about block_bytes reach the driver
        part = source.filter(F.pmod(F.col("hash"), F.lit(blocks)) == b) if blocks > 1 else source
        table = shared(spark, Block(part.select("width", "key", "words", "items").toArrow()))
        last = b == blocks - 1
        at = len(carried) + 1  # places of __items and __hits in a batch: after the text and the carried columns

        def run(chunk: Chunk, batch: pa.RecordBatch, table=table, last=last, at=at) -> dict:
            w, hit, found = _scan(chunk, table())
            before_items, before = batch.column(at).to_pylist(), batch.column(at + 1).to_pylist()
            for row, spans in enumerate(before):
                for s in spans:
                    hit[w.first[row] + s["start"]:w.first[row] + s["end"]] = True
            all_items = [sorted(found.get(r, set()) | set(x)) for r, x in enumerate(before_items)]
            # stretches of hit words, each within its row
            edge = np.ones(len(hit), bool)
            edge[1:] = ~hit[:-1] | (w.row[1:] != w.row[:-1])
            starts = np.flatnonzero(hit & edge)
            edge = np.ones(len(hit), bool)
            edge[:-1] = ~hit[1:] | (w.row[1:] != w.row[:-1])
            ends = np.flatnonzero(hit & edge) + 1
            by_row: list[list] = [[] for _ in range(chunk.n)]
            if not last:
                for s, e in zip(starts.tolist(), ends.tolist()):
                    r = int(w.row[s])
                    by_row[r].append({"start": s - int(w.first[r]), "end": e - int(w.first[r])})
                return {"__items": all_items, "__hits": by_row}
            points = chunk.points()
            cut: list[list] = [[] for _ in range(chunk.n)]
            for s, e in zip(starts.tolist(), ends.tolist()):
                r = int(w.row[s])
                base = points[chunk.off[r]]
                by_row[r].append({"start": int(points[w.start[s]] - base), "end": int(points[w.end[e - 1]] - base)})
                cut[r].append((int(w.start[s]), int(w.end[e - 1])))
            clean = chunk.column.to_pylist()
            for r in np.flatnonzero([bool(c) for c in cut]).tolist():
                lo, parts = int(chunk.off[r]), []
                for s, e in cut[r]:
                    parts.append(chunk.data[lo:s].tobytes())
                    lo = e
                parts.append(chunk.data[lo:chunk.off[r + 1]].tobytes())
                clean[r] = b"".join(parts).decode()
            return {"n_words": w.count, "n_hit": per_row(hit, w.first), "items": all_items, "spans": by_row, "clean_text": clean}

        if last:
            result = map_text(result, "__source", fields, run, keep=carried + ["__items", "__hits"]).drop("__items", "__hits")
        else:
            result = map_text(result, "__source", [T.StructField("__items", T.ArrayType(T.StringType())),
                                                   T.StructField("__hits", _SPANS)], run,
                              keep=carried + ["__items", "__hits", "__source"])
            result = written(result.select(*[quoted(c) for c in carried], "__source", "__items", "__hits"), "benchmark-hits")
    return result
