"""Byte-level BPE encoding and decoding in batched merge rounds.

The distinct pre-tokens of a chunk that are not yet known are encoded
together: their symbols lie in one flat array, and every round merges the
lowest-ranked pair of each word at once.  Ranks are found by binary search
over the sorted pair keys, and only for pairs that changed.  A word leaves
the array when it has no pair left to merge.

Cases: a null or empty text has no tokens and decodes to an empty text;
strings of special tokens in a text are those tokens; ids that the vocabulary
does not have decode to nothing, bytes that are no UTF-8 to U+FFFD; a pre-token of any
length is encoded whole (in time of its length times its merge rounds) and is
not remembered beyond ``LONGEST_KNOWN`` letters; an empty table gives no rows;
input columns with the names of result columns are replaced.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.stages import shared
from civicflow.llm.textmap import BATCH_ROWS, Chunk, map_text, others, quoted

# fixed value: the pattern that byte-level vocabularies split text with
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# bytes of pre-tokens and their ids that a worker remembers, about, and the longest one remembered
CACHE_BYTES = 16 << 20
LONGEST_KNOWN = 256
# bytes that remembering a pre-token takes beside its letters and ids
KNOWN_BYTES = 150
# rows decoded together
DECODE_ROWS = 64
_NEVER = np.int64(1) << 40


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself when visible, else from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        chars = byte_characters()
        back = {c: b for b, c in enumerate(chars)}
        self.byte_id = np.array([vocab[c] for c in chars], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        size = max([*vocab.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for token, i in vocab.items():
            texts[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            texts[i] = token.encode()
        self.token_length = np.array([len(t) for t in texts], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(texts), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (never, when it does not merge) and the symbol it becomes."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER), self.merged[at]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as packed 32-bit integers."""
        lengths = np.array([len(w) for w in words], np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_word, done_sym = [], []
        rank = np.full(len(sym), _NEVER)
        into = np.zeros(len(sym), np.int64)
        at = np.flatnonzero(word[:-1] == word[1:])
        rank[at], into[at] = self.rank(sym[at], sym[at + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            over = np.repeat(best == _NEVER, count)
            if over.any():
                done_word.append(word[over])
                done_sym.append(sym[over])
                stay = ~over
                sym, word, rank, into = sym[stay], word[stay], rank[stay], into[stay]
                if not len(sym):
                    break
                open_ = best != _NEVER
                best, count = best[open_], count[open_]
            chosen = np.flatnonzero(rank == np.repeat(best, count))
            # of overlapping pairs (a run of one symbol) every other one, from the left
            new_run = np.ones(len(chosen), bool)
            new_run[1:] = chosen[1:] != chosen[:-1] + 1
            place = np.arange(len(chosen))
            chosen = chosen[(place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0]
            sym[chosen] = into[chosen]
            stay = np.ones(len(sym), bool)
            stay[chosen + 1] = False
            sym, word, rank, into = sym[stay], word[stay], rank[stay], into[stay]
            moved = chosen - np.arange(len(chosen))
            changed = np.concatenate([moved, moved[moved > 0] - 1])
            end = changed + 1 < len(sym)
            rank[changed[~end]] = _NEVER
            changed = changed[end]
            inside = word[changed] == word[changed + 1]
            rank[changed[~inside]] = _NEVER
            changed = changed[inside]
            rank[changed], into[changed] = self.rank(sym[changed], sym[changed + 1])
        if not done_word:
            return [b""] * len(words)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        flat = sym[order].astype("<i4").tobytes()
        cut = (4 * np.searchsorted(word[order], np.arange(len(words) + 1))).tolist()
        return [flat[a:b] for a, b in zip(cut, cut[1:])]

    def decode_ids(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        known = (ids >= 0) & (ids < len(self.token_length))
        ids = np.where(known, ids, 0)
        length = np.where(known, self.token_length[ids], 0)
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(length, out=ends[1:])
        source = np.repeat(self.token_start[ids] - ends[:-1], length) + np.arange(ends[-1])
        raw = self.token_bytes[source].tobytes()
        cut = ends[off].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]


class Encoder:
    """Splits texts and encodes them; remembers pre-tokens up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.known: dict[str, bytes] = {}
        self.held = 0

    def split(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out += ["\x00special:" + part] if k % 2 else self.pattern.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        new = list(set().union(*pieces) - self.known.keys())
        special = [w for w in new if w.startswith("\x00special:")]
        plain = [w for w in new if not w.startswith("\x00special:")]
        self.known.update(zip(plain, self.vocabulary.encode_words([w.encode("utf-8", "replace") for w in plain])))
        for w in special:
            self.known[w] = np.array([self.vocabulary.special[w[9:]]], "<i4").tobytes()
        get = self.known.__getitem__
        out = [b"".join(map(get, p)) for p in pieces]
        for w in new:
            if len(w) > LONGEST_KNOWN:
                del self.known[w]
            else:
                self.held += KNOWN_BYTES + len(w) + len(self.known[w])
        return out


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """Adds ``ids``, the tokens of each text; ``path`` names the vocabulary file on the driver, which broadcasts it.

    ``decoded`` adds the text that the ids decode to, in the same pass and worker.
    """
    vocabulary = shared(docs.sparkSession, Vocabulary(path))
    state: dict[str, Encoder] = {}

    def run(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        if "encoder" not in state:
            state["encoder"] = Encoder(vocabulary())
        packed = state["encoder"].encode(chunk.strings())
        off = np.zeros(chunk.n + 1, np.int32)
        np.cumsum([len(p) // 4 for p in packed], out=off[1:])
        flat = np.frombuffer(b"".join(packed), "<i4")
        made: dict = {"ids": pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.int32()))}
        if decoded:
            made["decoded"] = vocabulary().decode_ids(flat.astype(np.int64), off)
        return made

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return map_text(docs, text, fields + [T.StructField("decoded", T.StringType())] * decoded, run, keep)


def decode(tokens: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded``, the text of each array of ids (null ids: empty)."""
    spark = tokens.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    vocabulary = shared(spark, Vocabulary(path))
    carried = others(list(tokens.columns if keep is None else keep), ["decoded"])
    source = tokens.select(F.coalesce(quoted(ids), F.array().cast("array<int>")).alias("i"),
                           *[quoted(c).alias(f"c{i}") for i, c in enumerate(carried)])
    types = source.schema
    schema = T.StructType([*[T.StructField(c, types[i + 1].dataType) for i, c in enumerate(carried)],
                           T.StructField("decoded", T.StringType())])

    def run(batches):
        names = [f.name for f in schema]
        for batch in batches:
            column = batch.column(0)
            flat = np.asarray(column.flatten().fill_null(-1)).astype(np.int64)
            off = np.asarray(column.offsets).astype(np.int64)
            off -= off[0]
            texts: list[str] = []
            for lo in range(0, batch.num_rows, DECODE_ROWS):
                part = off[lo:lo + DECODE_ROWS + 1]
                texts += vocabulary().decode_ids(flat[part[0]:part[-1]], part - part[0])
            yield pa.RecordBatch.from_arrays([*[batch.column(i + 1) for i in range(len(names) - 1)], pa.array(texts, pa.string())],
                                             names=names)

    return source.mapInArrow(run, schema)
