"""SQL that gives the rows of those queries that SQL can express, for DuckDB."""

from __future__ import annotations

from . import decontaminate, quality

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _item_words(table: str, key: str) -> str:
    text = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return f"SELECT {key}, list_filter(string_split_regex({text}, '{decontaminate.BREAK}'), lambda x: x <> '') AS w FROM {table}"


OP1 = f"""
WITH d AS ({_item_words("documents", "doc_id")}), b AS ({_item_words("benchmark", "item_id")}),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT item_id, w, least(len(w), {decontaminate.WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {decontaminate.WINDOW}) + 2)) AS i
        FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM pos JOIN win USING (n, t)),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, COUNT(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _quantiles(keys: str) -> str:
    at = lambda p: f"MIN(CASE WHEN upto * 100 >= docs * {p} THEN cell END)"
    return f"""SELECT {keys}, metric, MAX(docs) AS docs, {at(10)} AS low, {at(50)} AS mid, {at(90)} AS high FROM (
  SELECT *, SUM(n) OVER (PARTITION BY {keys}, metric ORDER BY cell) AS upto, SUM(n) OVER (PARTITION BY {keys}, metric) AS docs
  FROM (SELECT {keys}, metric, cell, COUNT(*) AS n FROM cells GROUP BY ALL)) GROUP BY ALL"""


_RATIOS = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"),
           "word_chars": ("word_chars", "n_words")}
_MORE = quality.ONE_MORE
_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, '{m}' AS metric, {num} * {quality.UNIT} // greatest({den}, 1) AS v, "
    + (f"({num} + {_MORE[m]}) * {quality.UNIT} // ({den} + {_MORE[m]})" if m in _MORE else f"{num} * {quality.UNIT} // greatest({den}, 1)")
    + " AS r FROM m" for m, (num, den) in _RATIOS.items())
_LIMITS = " UNION ALL ".join(f"SELECT '{m}' AS metric, {s} AS up, {quality.LOWER.get(m, 0)} AS down" for m, s in quality.UPPER.items())


def _width(v: str) -> str:
    return f"(CAST(1 AS BIGINT) << CAST(greatest(length(bin({v})) - {quality.SKETCH_BITS}, 0) AS BIGINT))"


OP7 = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{quality.SPACE}+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
again AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(i, i + 5)) AS p FROM wins JOIN (SELECT doc_id, t FROM wins GROUP BY ALL HAVING COUNT(*) > 1) USING (doc_id, t)) GROUP BY 1),
m AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN again USING (doc_id)),
vals AS ({_VALUES}),
celled AS (SELECT *, v // {_width("v")} * {_width("v")} AS cell, r // {_width("r")} * {_width("r")} AS rcell FROM vals),
cells AS (SELECT c.lang, c.source, c.metric, c.rcell AS cell FROM celled c JOIN m USING (doc_id) WHERE n_words > 0),
own AS ({_quantiles("lang, source")}), whole AS ({_quantiles("lang")}), limits AS ({_LIMITS}),
picked AS (SELECT own.lang, own.source, own.metric,
    CASE WHEN own.docs < {quality.LEAST_GROUP} THEN whole.low ELSE own.low END AS low,
    CASE WHEN own.docs < {quality.LEAST_GROUP} THEN whole.mid ELSE own.mid END AS mid,
    CASE WHEN own.docs < {quality.LEAST_GROUP} THEN whole.high ELSE own.high END AS high
  FROM own JOIN whole ON own.lang IS NOT DISTINCT FROM whole.lang AND own.metric = whole.metric),
fences AS (SELECT lang, source, metric, mid + greatest(up * (high - mid), {_width("mid")}) AS top,
    CASE WHEN down > 0 THEN mid - greatest(down * (mid - low), {_width("mid")}) ELSE 0 END AS bottom FROM picked JOIN limits USING (metric)),
good AS (SELECT c.doc_id, bool_and(coalesce(cell <= top AND cell >= bottom, true)) AS ok FROM celled c LEFT JOIN fences f
  ON c.lang IS NOT DISTINCT FROM f.lang AND c.source IS NOT DISTINCT FROM f.source AND c.metric = f.metric GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words) AND ok AS kept
FROM m JOIN good USING (doc_id)"""


OP13 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS alike, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM r a, r c WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

_TERMS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(table: str, key: str) -> str:
    text = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return f"SELECT row_number() OVER () AS r, {key}, list_filter(string_split_regex({text}, '{_TERMS}'), lambda x: x <> '') AS w FROM {table}"


OP11 = f"""
WITH d AS ({_terms("documents", "doc_id")}), b AS ({_terms("benchmark", "item_id")}),
total AS (SELECT COUNT(*) AS n_docs, SUM(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT r AS item, item_id, unnest(w) AS term FROM b),
tf AS (SELECT r, doc_id, n, term, COUNT(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS wt FROM tf, total GROUP BY term),
s AS (SELECT item, item_id, r, doc_id, CAST(SUM(wt * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN wt USING (term), total GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""
