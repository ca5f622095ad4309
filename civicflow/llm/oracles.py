"""DuckDB SQL of the numbered queries that SQL can express, over the whole tables."""

# words between ASCII white space, and the words of normalised text
_SPACE_WORDS = r"coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), [])"
_ALNUM_WORDS = r"coalesce(regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

# a window is known by the digest of its words: they hold no space
ORACLES["op2_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_SPACE_WORDS.format(text="text")} AS w FROM documents),
starts AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS p FROM d)),
again AS (SELECT win FROM starts GROUP BY win HAVING COUNT(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, p + o AS pos
  FROM (SELECT doc_id, p, unnest(range(0, 35)) AS o FROM starts SEMI JOIN again USING (win))),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, COUNT(*) AS n FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op8_jaccard_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACE_WORDS.format(text=_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, r.component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""

ORACLES["op10_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS.format(text=_LOWER)} AS w FROM documents),
i AS (SELECT item_id, {_ALNUM_WORDS.format(text=_LOWER)} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
widths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, widths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, p FROM doc_windows JOIN item_windows USING (n, win)),
hit_words AS (SELECT doc_id, COUNT(DISTINCT p + o) AS n_hit FROM (SELECT doc_id, p, unnest(range(0, n)) AS o FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_TERMS = r"coalesce(regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])"

ORACLES["op11_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(text=_LOWER)} AS w FROM documents),
stats AS (SELECT COUNT(*) AS n_docs, SUM(len(w)) AS total FROM d WHERE len(w) > 0),
lengths AS (SELECT r, doc_id, 50 + (50 * len(w) * n_docs) // total AS m FROM d, stats WHERE len(w) > 0),
tf AS (SELECT r, term, COUNT(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
queries AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS.format(text=_LOWER)}) AS term FROM benchmark)),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS weight
  FROM tf, stats WHERE term IN (SELECT term FROM queries) GROUP BY term, n_docs),
scores AS (
  SELECT item_id, r, doc_id, SUM(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS score
  FROM queries JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (r) GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 50
"""

ORACLES["op12_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, MAX(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, often.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN often USING (key))
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
