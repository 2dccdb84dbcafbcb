"""SQL whose rows must equal those of the registered queries, where SQL can say it."""

from __future__ import annotations

from lakemill.llm.license_join import PHRASES, TELLING, TEMPLATES, THRESHOLD, template_words

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SQL: dict[str, str] = {}

_SQL["op10_ngram_jaccard_join"] = rf"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, least(i + 2, len(w))), ' ') AS s
  FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i) AS p),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)),
two_way AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN two_way e ON r.other = e.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""


_TEMPLATES = ", ".join(
    f"({t}, '{label}', {sorted(set(w))}, {list(TELLING[t])}::VARCHAR[], {-(-len(w) * 5 // 4)})"
    for t, (label, text) in enumerate(TEMPLATES) for w in [template_words(text)])
_PLACES = " UNION ALL ".join(
    f"""SELECT doc_id, i, '{label}' AS label FROM words, LATERAL (SELECT unnest(range(len(w))) AS i) AS p
    WHERE list_slice(w, i + 1, i + {len(phrase.split())}) = {phrase.split()}""" for phrase, label in PHRASES)

_SQL["op7_license_scan"] = rf"""
WITH lowered AS (SELECT doc_id, {_LOWER} AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
places AS ({_PLACES}),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id),
templates(template, label, words, telling, span) AS (VALUES {_TEMPLATES}),
-- A block can only meet a template if its whole text does.
pairs AS (
  SELECT doc_id, w, label, words, telling, span FROM (SELECT doc_id, w, list_distinct(w) AS held FROM words), templates
  WHERE list_has_all(held, telling) AND len(list_intersect(words, held)) >= {THRESHOLD} * len(words) - 1e-9),
blocks AS (
  SELECT doc_id, label, words, telling, list_slice(w, i, i + span - 1) AS block
  FROM pairs, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i) AS p WHERE list_contains(words, w[i])),
met AS (
  SELECT doc_id, label, len(list_intersect(words, list_distinct(block))) / len(words) AS share FROM blocks
  WHERE list_has_all(block, telling) AND len(list_intersect(words, list_distinct(block))) >= {THRESHOLD} * len(words) - 1e-9),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS best FROM met GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
  CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(f.best, 0.0)::DOUBLE END AS score
FROM words d LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

_DRAWS = ", ".join(f"('0x' || substr(md5(doc_id || ':{s}'), 1, 13))::BIGINT AS d{s}" for s in range(9))
_SQL["op4_rendezvous_shards"] = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
hexed AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b FROM documents),
bytes AS (SELECT doc_id, list_transform(b, lambda h: ('0x' || h)::BIGINT) AS b FROM hexed),
sums AS (
  SELECT doc_id, len(b) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table),
drawn AS (SELECT *, {_DRAWS} FROM sums),
owned AS (
  SELECT doc_id, size, text_crc32,
    list_position([{", ".join(f"d{s}" for s in range(8))}], greatest({", ".join(f"d{s}" for s in range(8))})) - 1 AS shard,
    list_position([{", ".join(f"d{s}" for s in range(9))}], greatest({", ".join(f"d{s}" for s in range(9))})) - 1 AS grown_shard
  FROM drawn)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(concat_ws(':', doc_id, size, text_crc32)), 1, 3), doc_id, size, text_crc32) - 1 AS slot
FROM owned
"""

_SQL["op12_phrase_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, doc, piece, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
  LATERAL (SELECT unnest(ps) AS p, unnest(range(len(ps))) AS piece) AS s),
places AS (
  SELECT lang, k, w[i:i + k - 1] AS words FROM pieces,
  LATERAL (SELECT unnest(range(1, 6)) AS k) AS ks, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i) AS p),
totals AS (SELECT lang, count(*) AS n FROM places WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, array_to_string(words, ' ') AS phrase, any_value(words) AS words, count(*) AS c
  FROM places GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT * FROM f WHERE k > 1),
inner_phrases AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, c
  FROM candidates, LATERAL (SELECT unnest(range(2, k)) AS m) AS ms, LATERAL (SELECT unnest(range(1, k - m + 2)) AS i) AS p),
open_phrases AS (
  SELECT c.* FROM candidates c LEFT JOIN (SELECT lang, phrase, max(c) AS most FROM inner_phrases GROUP BY ALL) o USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < 100 * c.c),
cuts AS (
  SELECT p.lang, p.phrase, p.c AS a, j, x.c AS l, y.c AS r, t.n,
    (1000::HUGEINT * p.c * t.n) // (x.c::HUGEINT * y.c) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM open_phrases) p JOIN totals t USING (lang)
  JOIN f x ON x.lang = p.lang AND x.phrase = array_to_string(p.words[1:j], ' ')
  JOIN f y ON y.lang = p.lang AND y.phrase = array_to_string(p.words[j + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM numbered WHERE rank <= 2000
"""


def statements() -> dict[str, str]:
    return dict(_SQL)
