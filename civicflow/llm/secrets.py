"""Secret scan: fixed forms, and sliding-window entropy over candidate strings.

Fixed forms (base spans): assignments of a password, token or key, access key
ids, and long runs of lower-case hexadecimal digits; matches that are too
short are dropped.  The entropy method looks at every run of 20 or more token
characters: the Shannon entropy of each ``WINDOW``-character window, updated
from the counts of the characters that enter and leave, must reach the
threshold of the window's character class.  Windows that do, joined, are a
span.  Of a run on the allow list, only the parts on it are left out.

Spans are kind:start:end in code points, end exclusive.

Cases: a null or empty text has no spans; a text is scanned whole; repeated
rows give the same spans; an empty table gives no rows; input columns with
the names of result columns are replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from civicflow.llm.textmap import Chunk, Words, map_text

# fixed values: the base forms and their least lengths
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
# bits per character that a window of each class must reach
THRESHOLDS = {"hex": 3.0, "alnum": 3.6, "base64": 3.9}
# strings that look random but are no secrets: placeholders, documentation keys, host and file names, digests of nothing
ALLOW = (r"(?i).*example.*", r"(?i).*(abcdefghij|0123456789|qwertyuiop).*", r"(?i)(x{4,}|your|dummy|sample|test).*",
         r"(?i)[a-z0-9.-]+\.(com|org|net|io|html?|php|js|css|png|jpe?g|pdf|txt)(/.*)?", r"[0-9a-f]{8}-0000-.*",
         r"d41d8cd98f00b204e9800998ecf8427e", r"da39a3ee5e6b4b0d3255bfef95601890afd80709",
         r"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_C_LOG_C = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def random_stretches(s: str, thresholds: dict[str, float] = THRESHOLDS) -> list[tuple[int, int]]:
    """Joined windows of ``s`` whose entropy reaches the threshold of their class.

    Classes of a window: hex (one case, digits and letters), alnum (digits
    and letters), base64 (digits, letters and symbols); a window without a
    digit or without a letter has none.
    """
    out: list[tuple[int, int]] = []
    counts: dict[str, int] = {}
    total = 0.0
    digits = letters = symbols = upper = beyond = 0
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += _C_LOG_C[n + 1] - _C_LOG_C[n]
        counts[c] = n + 1
        if c.isdigit():
            digits += 1
        elif c.isalpha():
            letters += 1
            upper += c.isupper()
            beyond += c not in "abcdefABCDEF"
        else:
            symbols += 1
        if i >= WINDOW - 1:
            if digits and letters:
                kind = "base64" if symbols else "hex" if not beyond and upper in (0, letters) else "alnum"
                if math.log2(WINDOW) - total / WINDOW >= thresholds[kind] - 1e-9:
                    lo = i - WINDOW + 1
                    if out and lo <= out[-1][1]:
                        out[-1] = (out[-1][0], i + 1)
                    else:
                        out.append((lo, i + 1))
            d = s[i - WINDOW + 1]
            n = counts[d]
            total -= _C_LOG_C[n] - _C_LOG_C[n - 1]
            counts[d] = n - 1
            if d.isdigit():
                digits -= 1
            elif d.isalpha():
                letters -= 1
                upper -= d.isupper()
                beyond -= d not in "abcdefABCDEF"
            else:
                symbols -= 1
    return out


def parts_to_scan(s: str, allow: list[re.Pattern]) -> list[tuple[int, int]]:
    """What of a run on the allow list stays to be looked at.

    A piece between / and = that is on the list goes: the segments of it that
    match by themselves, or all of it when the pattern needs several (a host).
    """
    gone = np.zeros(len(s), bool)
    for piece in re.finditer(r"[^/=]+", s):
        for p in allow:
            if p.fullmatch(piece[0]):
                own = [m for m in re.finditer(r"[^._-]+", piece[0]) if p.fullmatch(m[0])]
                for a, b in [m.span() for m in own] or [(0, len(piece[0]))]:
                    gone[piece.start() + a:piece.start() + b] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
    return [(a, b) for a, b in edge.reshape(-1, 2).tolist() if b - a >= WINDOW]


def spans(chunk: Chunk, allow: tuple[str, ...] = ALLOW) -> list[list[tuple[int, int, int]]]:
    """For each row the spans (start, place of the kind, end) in order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(chunk.n)]
    raw = chunk.data.tobytes()
    low = raw.lower()
    words = [k for k in KEYWORDS if k in low]
    keyed = bool(words)
    access = b"AKIA" in raw
    if keyed or access:
        texts = chunk.column.to_pylist()
        for r in range(chunk.n):
            lo, hi = int(chunk.off[r]), int(chunk.off[r + 1])
            if keyed and any(low.find(k, lo, hi) >= 0 for k in words):
                for m in ASSIGN.finditer(texts[r]):
                    if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                        out[r].append((m.start(), 0, m.end()))
            if access and raw.find(b"AKIA", lo, hi) >= 0:
                for m in ACCESS.finditer(texts[r]):
                    if m.end() - m.start() >= ACCESS_LEAST:
                        out[r].append((m.start(), 1, m.end()))
    points = None
    allowed = [re.compile(a.replace("(?i)", ""), re.IGNORECASE) for a in allow]
    anywhere = re.compile("|".join(f"(?:{a.pattern})" for a in allowed), re.IGNORECASE) if allow else None
    for table, least, kind in ((_HEX, HEX_LEAST, 2), (_TOKEN, WINDOW, 3)):
        runs = Words(chunk.data, chunk.off, table)
        long = np.flatnonzero(runs.end - runs.start >= least)
        if len(long) and points is None:
            points = chunk.points()
        for i in long.tolist():
            s, e, r = int(runs.start[i]), int(runs.end[i]), int(runs.row[i])
            base = int(points[s] - points[chunk.off[r]])
            if kind == 2:
                out[r].append((base, 2, base + e - s))
                continue
            word = raw[s:e].decode()
            parts = parts_to_scan(word, allowed) if anywhere and anywhere.fullmatch(word) else [(0, len(word))]
            out[r].extend((base + lo + a, 3, base + lo + b) for lo, hi in parts for a, b in random_stretches(word[lo:hi]))
    for found in out:
        found.sort()
    return out


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Adds ``secrets``: an array of (kind, start, end, value) by start, then kind."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())])

    def run(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        found = spans(chunk, allow)
        texts = chunk.column.to_pylist() if any(found) else []
        return {"secrets": [[{"kind": KINDS[k], "start": s, "end": e, "value": texts[r][s:e]} for s, k, e in f]
                            for r, f in enumerate(found)]}

    return map_text(docs, text, [T.StructField("secrets", T.ArrayType(span))], run, keep)
