"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set: its distinct shingles of ``WIDTH`` words (A-Z in lower
case); the whole sequence when it has fewer words.  Two documents link when
100 * intersection >= ``PERCENT`` * union.

For any order of all shingles, the first n - ceil(0.8 n) + l shingles of two
sets that link have at least l in common.  Documents whose shingles are rare
first in that order therefore drop out early:

1. Equal sets collapse to one class (a hash of the set and its size).
2. Of the shingles in a fixed part of the hash space, those in a single
   class are counted back to it.  A class with more than n - ceil(0.8 n) of
   them links with none and is done; nothing but counts is shuffled for it.
3. The remaining classes get the frequency of all their shingles.  Each takes
   the prefix whose length l minimises its estimated cost: postings to read
   plus candidates to verify, of which l common shingles leave 1 / l at most.
4. In each of a few rounds, every class is verified against one leader of
   its postings (first the one whose shingles are the most common, in a group
   of near copies the text that they vary), and classes that link are joined.
   Pairs within one component are not needed for it, so groups of thousands
   of near copies stay linear.
5. Then all remaining pairs of classes in different components are looked at,
   each from the class whose component has the greater label.
   Their common prefix shingles are counted over posting lists in blocks of
   about ``BLOCK`` classes; a pair is verified when it shares the smaller l
   of the two at least, and when its count and all shingles beyond the
   prefixes could together reach the similarity.

Shingles are compared as 64-bit hashes.

Cases: a null or empty text, or one without words, has n_shingles 0 and is a
component of its own; rows with a null id are returned with a null component
and link with none; repeated rows (of id and text) each get their row; an
empty table gives no rows; other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow import session
from civicflow.llm.components import connected
from civicflow.llm.stages import written
from civicflow.llm.textmap import LOWER, NOT_SPACE, Chunk, Words, emit_rows, map_text, mix, quoted, windows

WIDTH = 5
PERCENT = 80
# the part of the hash space that step 2 looks at; more than 1 - PERCENT / 100
PROBE = 0.28
# rounds against leaders before all remaining pairs are verified
ROUNDS = 2
# common shingles that a document may be made to need, at most
MOST = 16
# classes in a block of a posting list, about
BLOCK = 500


def shingles(chunk: Chunk, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the distinct shingle hashes, ascending: (row, hash) flat, the size of each set and a hash of it."""
    w = Words(LOWER[chunk.data], chunk.off, NOT_SPACE)
    h = w.hashes()
    at, hashed = windows(h, w.row, width)
    rows, values = [w.row[at]], [hashed]
    short = (w.count > 0) & (w.count < width)
    for size in range(1, width):
        if (short & (w.count == size)).any():
            at, hashed = windows(h, w.row, size)
            whole = w.count[w.row[at]] == size
            rows.append(w.row[at][whole])
            values.append(mix(hashed[whole] + np.uint64(size)))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[first], value[first]
    size = np.bincount(row, minlength=chunk.n)
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(mix(value ^ np.uint64(0xA0761D6478BD642F)), out=sums[1:])
    cut = np.concatenate([[0], np.cumsum(size)])
    key = mix(sums[cut[1:]] - sums[cut[:-1]] + size.astype(np.uint64))
    return row, value, size, key


def _free(n, percent: int):
    """Shingles of a set of n that may be missing in one it links with: n - ceil(percent * n / 100)."""
    return n - (percent * n + 99) // 100


def prefixes(grouped: DataFrame, percent: int) -> DataFrame:
    """Postings of classes (k, n, found: array of (df, tok) of the shingles in two classes or more).

    (tok, k, n, need, rest, shared, common): need is l, rest the shingles
    beyond the prefix, shared those in other classes at all, common the mean
    log frequency of the class's shingles.
    """
    names = ["tok", "k", "n", "need", "rest", "shared"]
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in names], T.StructField("common", T.DoubleType())])

    def run(batches):
        for batch in batches:
            toks, rows = [np.zeros(0, np.int64)], []
            found = batch.column("found")
            flat = found.flatten()
            df_all, tok_all = np.asarray(flat.field("df")), np.asarray(flat.field("tok"))
            off = np.asarray(found.offsets) - found.offsets[0].as_py()
            for i, (k, n) in enumerate(zip(batch.column("k").to_pylist(), batch.column("n").to_pylist())):
                df, tok = df_all[off[i]:off[i + 1]], tok_all[off[i]:off[i + 1]]
                alone = n - len(df)
                order = np.lexsort((tok, df))
                df, tok = df[order], tok[order]
                # shared shingles in a prefix of free + l shingles: those beyond the ones that no other class has
                base = int(_free(n, percent)) - alone
                if base < 0:
                    continue  # even the prefix for l = 1 holds none
                last = min(MOST, len(df) - base)
                reads = np.concatenate([[0], np.cumsum(df - 1.0)])
                ell = np.arange(1, last + 1)
                total = reads[base + ell]
                cost = total + total / ell * (4 + n / 64)
                best = int(ell[np.argmin(cost)])
                length = base + best
                toks.append(tok[:length])
                rows.append((length, k, n, best, n - alone - length, len(df), float(np.log(df).sum() / n)))
            count, *cols = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(toks)),
                                              *[pa.array(np.repeat(np.array(c, np.int64), count)) for c in cols[:-1]],
                                              pa.array(np.repeat(np.array(cols[-1], np.float64), count))],
                                             names=[*names, "common"])

    return grouped.select("k", "n", "found").mapInArrow(run, schema)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    left = sets.select(F.col("k").alias("a"), F.col("toks").alias("x"))
    right = sets.select(F.col("k").alias("b"), F.col("toks").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(both * (100 + percent) >= percent * (F.size("x") + F.size("y"))).select("a", "b"))


def _near(n, m, shared, other, percent: int):
    """Whether sets of n and m shingles, of which so many are in other classes at all, can link."""
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * percent)
            & (F.least(shared, other) * (100 + percent) >= (n + m) * percent))


def pairs_of_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) to verify, from rows (a, part, na, la, ra, sa, laba, block): a posting of class a beside a block of classes.

    ``block`` holds (k, n, need, rest, shared, lab) of the classes of one part
    that have the posting's shingle and a smaller label than a; all rows of a
    class and part come together, so all common shingles of a pair are counted
    at once and counting holds one class's blocks of one part at a time.
    """
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    fields = ("k", "n", "need", "rest", "shared", "lab")

    def count(held: list) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        block = table.column("block").chunk(0) if table.num_rows else None
        flat = block.flatten()
        times = np.diff(np.asarray(block.offsets))
        mine = {c: np.repeat(table.column(c).to_numpy(), times) for c in ("a", "na", "la", "ra", "sa", "laba")}
        its = {c: np.asarray(flat.field(c)) for c in fields}
        n, m = mine["na"], its["n"]
        keep = ((mine["laba"] > its["lab"]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
                & (np.minimum(mine["sa"], its["shared"]) * (100 + percent) >= (n + m) * percent))
        a, b = mine["a"][keep], its["k"][keep]
        need = np.minimum(mine["la"], its["need"])[keep]
        rest = np.maximum(mine["ra"], its["rest"])[keep]
        total = (n + m)[keep]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        common = np.diff(np.append(first, len(a)))
        at = order[first]
        good = (common >= need[at]) & ((common + rest[at]) * (100 + percent) >= total[at] * percent)
        a, b = a[first][good], b[first][good]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])

    def run(batches):
        held: list = []
        for batch in batches:
            a, part = batch.column("a").to_numpy(), batch.column("part").to_numpy()
            change = np.flatnonzero((a[1:] != a[:-1]) | (part[1:] != part[:-1])) + 1
            if held and (held[-1].column("a")[-1].as_py(), held[-1].column("part")[-1].as_py()) != (a[0], part[0]):
                yield count(held)
                held = []
            cut = int(change[-1]) if len(change) else 0
            if cut:
                yield count([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield count(held)

    return rows.mapInArrow(run, schema).distinct()


def link_classes(prefix: DataFrame, sets: DataFrame, percent: int, rounds: int) -> DataFrame:
    """Edges (a, b) between classes that connect all classes that links connect; without rounds all links, each once."""
    spark = prefix.sparkSession
    edges = spark.createDataFrame([], "a long, b long")
    labelled = prefix.withColumn("lab", F.col("k"))

    def open_postings(labelled: DataFrame) -> DataFrame:
        """Postings of shingles whose classes are in several components."""
        mixed = labelled.groupBy("tok").agg(F.min("lab").alias("lo"), F.max("lab").alias("hi")).filter("lo <> hi").select("tok")
        return labelled.join(mixed, "tok", "left_semi")

    for turn in range(rounds):
        postings = open_postings(labelled)
        first = F.col("common") if turn == 0 else F.xxhash64("k", F.lit(turn)).cast("double")
        leaders = postings.groupBy("tok").agg(F.max(F.struct(first.alias("o"), "k", "n", "shared", "lab")).alias("head"))
        tried = (postings.join(leaders, "tok")
                 .filter((F.col("lab") != F.col("head.lab"))
                         & _near(F.col("n"), F.col("head.n"), F.col("shared"), F.col("head.shared"), percent))
                 .groupBy(F.col("k").alias("a"), F.col("head.k").alias("b")).agg(F.count("*").alias("c"))
                 .groupBy("a").agg(F.max_by("b", F.struct("c", "b")).alias("b")))
        edges = written(edges.unionByName(verified(tried, sets, percent)), "links")
        labels = written(connected(edges), "labels")
        labelled = prefix.join(labels.withColumnRenamed("node", "k").hint("merge"), "k", "left").withColumn(
            "lab", F.coalesce("component", "k")).drop("component")
        labelled = written(labelled, "labelled")
    # all remaining pairs of different components, each from the class with the greater label, whichever shingle they share;
    # classes of a shingle's most frequent component meet only those outside it, so a large component is not paired with itself
    postings = written(open_postings(labelled), "postings")
    sizes = postings.groupBy("tok", "lab").agg(F.count("*").alias("c")).groupBy("tok").agg(
        F.max_by("lab", F.struct("c", "lab")).alias("major"), F.min("lab").alias("least"), F.sum("c").alias("size"))
    longest = sizes.agg(F.max("size")).first()[0] or 1
    # the same parts in all lists: what a class shares with another is counted in one place
    parts = -(-longest // BLOCK)
    part = F.pmod(F.xxhash64("k", F.lit(99)), F.lit(parts)).alias("part")
    placed = postings.join(sizes.select("tok", "major", "least"), "tok")

    def beside(rows: DataFrame, others: DataFrame) -> DataFrame:
        blocks = others.groupBy("tok", part).agg(F.collect_list(F.struct("k", "n", "need", "rest", "shared", "lab")).alias("block"))
        own = rows.select("tok", F.col("k").alias("a"), F.col("n").alias("na"), F.col("need").alias("la"), F.col("rest").alias("ra"),
                          F.col("shared").alias("sa"), F.col("lab").alias("laba"))
        smaller = F.filter("block", lambda c: c["lab"] < F.col("laba")).alias("block")
        return own.join(blocks, "tok").select("a", "part", "na", "la", "ra", "sa", "laba", smaller).filter(F.size("block") > 0)

    few = beside(placed.filter("lab <> major and lab > least"), postings)
    most = beside(placed.filter("lab = major and lab > least"), placed.filter("lab <> major and lab < major"))
    both = few.unionByName(most).repartition("a", "part").sortWithinPartitions("a", "part")
    return written(edges.unionByName(verified(pairs_of_blocks(both, percent), sets, percent)), "links")


def classes_of(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, n, k) of every row, its set's size and class; the sets of classes that may link; and their postings."""
    session.configure(docs.sparkSession)
    source = docs.select(quoted(doc_id).alias("id"), quoted(text).cast("string").alias("text"))

    def sized(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        _, _, size, key = shingles(chunk, width)
        return {"n": size, "k": key.view(np.int64)}

    meta = written(map_text(source, "text", [T.StructField("n", T.LongType()), T.StructField("k", T.LongType())], sized, keep=["id"]),
                   "sets")
    usable = meta.filter("id is not null and n > 0")
    pair = T.StructType([T.StructField("tok", T.LongType()), T.StructField("k", T.LongType())])
    limit = np.uint64(int(PROBE * 2 ** 64))

    def probe(chunk: Chunk, batch: pa.RecordBatch) -> list:
        row, value, size, key = shingles(chunk, width)
        # copies within the chunk once
        _, one = np.unique(key, return_index=True)
        alone = np.zeros(chunk.n, bool)
        alone[one] = True
        take = alone[row] & (value < limit)
        # 48 bits: a false match only keeps a class for step 3
        return [pa.array((value[take] >> np.uint64(16)).view(np.int64)), pa.array(key[row[take]].view(np.int64))]

    seen = emit_rows(source.filter("id is not null and text is not null"), "text", [], pair, probe)
    single = (seen.groupBy("tok").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).filter("lo = hi")
              .groupBy(F.col("lo").alias("k")).agg(F.count("*").alias("u")))
    classes = usable.groupBy("k").agg(F.min("id").alias("rep"), F.min("n").alias("n"))
    free = F.expr(f"n - (({percent} * n + 99) div 100)")
    alive = written(classes.join(single, "k", "left").filter(F.coalesce("u", F.lit(0)) <= free).select("k", "rep"), "alive")

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("want", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("toks", T.ArrayType(T.LongType()))])

    def full(chunk: Chunk, batch: pa.RecordBatch) -> list:
        row, value, size, key = shingles(chunk, width)
        off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return [pa.array(key.view(np.int64)), batch.column(1), pa.array(size.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(off), pa.array(value.view(np.int64)))]

    # the same plan at every size: these tables grow with the input, so none is broadcast while it happens to be small
    chosen = source.join(alive.select(F.col("rep").alias("id"), F.col("k").alias("want")).hint("merge"), "id")
    sets = emit_rows(chosen, "text", ["want"], schema, full).filter("k = want").select("k", "n", "toks")
    if not usable.groupBy("id").count().filter("count > 1").isEmpty():
        sets = sets.dropDuplicates(["k"])
    sets = written(sets, "alive-sets")
    flat = sets.select("k", "n", F.explode("toks").alias("tok"))
    shared = flat.groupBy("tok").agg(F.count("*").alias("df")).filter("df > 1")
    grouped = flat.join(shared, "tok").groupBy("k").agg(F.first("n").alias("n"), F.collect_list(F.struct("df", "tok")).alias("found"))
    return meta, sets, written(prefixes(grouped, percent), "prefixes")


def members(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
            percent: int = PERCENT) -> DataFrame:
    """(id, n, k, c, component_id) of every row: its set's size and class, its component's label (null if it links with
    none) and the smallest id of its component."""
    meta, sets, prefix = classes_of(docs, doc_id, text, width, percent)
    edges = link_classes(prefix, sets, percent, ROUNDS)
    labels = written(connected(edges), "components")
    member = meta.join(labels.withColumnRenamed("node", "k"), "k", "left").select(
        "id", "n", "k", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.coalesce("component", "k")).alias("c"))
    least = member.filter("c is not null").groupBy("c").agg(F.min("id").alias("component_id"))
    linked = member.filter("c is not null").join(least, "c").select("id", "n", "k", "c", "component_id")
    lone = member.filter("c is null").select("id", "n", "k", "c", F.col("id").alias("component_id"))
    return linked.unionByName(lone)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest id that links reach, its own included."""
    return members(docs, doc_id, text, width, percent).select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id")


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
          percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links: pairs of classes of equal sets, and the class and number of links of every row.

    The pairs (a, b, id_a, id_b), each once, a < b: classes that link and the
    smallest id of each.  The rows (doc_id, n_shingles, class, n_links):
    n_links counts the other rows that the row links with, those of its own
    class included; a row without an id or without words has a null class and
    no links.  Every candidate pair is verified, also inside a component, so
    the result grows with the square of a group of near copies.
    """
    meta, sets, prefix = classes_of(docs, doc_id, text, width, percent)
    edges = link_classes(prefix, sets, percent, 0)
    usable = F.col("id").isNotNull() & (F.col("n") > 0)
    size = written(meta.filter(usable).groupBy("k").agg(F.min("id").alias("rep"), F.count("*").alias("rows")), "classes")
    pairs = (edges.join(size.select(F.col("k").alias("a"), F.col("rep").alias("id_a")), "a")
             .join(size.select(F.col("k").alias("b"), F.col("rep").alias("id_b")), "b").select("a", "b", "id_a", "id_b"))
    ends = edges.select(F.col("a").alias("k"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("k"), F.col("a").alias("other")))
    beside = (ends.join(size.select(F.col("k").alias("other"), "rows"), "other")
              .groupBy("k").agg(F.sum("rows").alias("beside")))
    own = size.join(beside, "k", "left").select("k", (F.col("rows") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"))
    # rows without a class meet no key
    keyed = meta.select("id", "n", F.when(usable, F.col("k")).alias("k"))
    rows = keyed.join(own, "k", "left").select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                                               F.col("k").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return pairs, rows


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                percent: int = PERCENT) -> DataFrame:
    """The documents, one of each component: the one with the smallest id (of rows that repeat it, one).

    Documents without an id or without words link with none and all stay.
    """
    found = written(members(docs, doc_id, text, width, percent), "members")
    grouped = found.filter("id is not null and n > 0")
    # of several rows of a component with the smallest id, those with the least class; an id may be on rows of several components
    winners = grouped.filter("id = component_id").groupBy("c").agg(F.min("id").alias("id"), F.min("k").alias("k")).select("id", "k")
    names = docs.columns
    source = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(names)], quoted(doc_id).alias("id"),
                         quoted(text).cast("string").alias("text"))

    def sized(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        _, _, size, key = shingles(chunk, width)
        return {"n": size, "k": key.view(np.int64)}

    keyed = map_text(source, "text", [T.StructField("n", T.LongType()), T.StructField("k", T.LongType())], sized,
                     keep=[f"c{i}" for i in range(len(names))] + ["id"])
    alone = keyed.filter("id is null or n = 0")
    kept = keyed.filter("id is not null and n > 0").join(winners, ["id", "k"], "left_semi")
    if not grouped.groupBy("id", "k").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "k"])
    columns = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return kept.select(*columns).unionByName(alone.select(*columns))
