"""Expected answers as SQL, for the operators that SQL can express on whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '{_WORD}')"


SUBSTRINGS_OF_BYTES = """
WITH raw AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
chunk AS (
  SELECT doc_id, octet_length(b) AS n, c, hex(b[c * 1000 + 1 : c * 1000 + 1199]) AS x
  FROM raw, unnest(range(0, octet_length(b) // 1000 + 1)) AS t(c)),
win AS (
  SELECT doc_id, c * 1000 + s AS s, md5_number(substr(x, 2 * s - 1, 400)) AS k
  FROM chunk, unnest(range(1, least(1001, length(x) // 2 - 198))) AS t(s)),
many AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
starts AS (SELECT doc_id, s FROM win WHERE k IN (SELECT k FROM many)),
runs AS (
  SELECT doc_id, s, sum(CASE WHEN s <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run
  FROM (SELECT doc_id, s, coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), -1000) AS before FROM starts)),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 199 AS z FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans),
gone AS (
  SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, max(z) AS last FROM spans GROUP BY doc_id),
head AS (
  SELECT c.doc_id, string_agg(hex(b[last + 1 : a - 1]), '' ORDER BY a) AS x
  FROM cuts c JOIN raw r ON r.doc_id = c.doc_id GROUP BY c.doc_id)
SELECT r.doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN g.doc_id IS NULL THEN b ELSE unhex(coalesce(x, '') || hex(b[last + 1 : octet_length(b)])) END) AS kept_sha256
FROM raw r LEFT JOIN gone g ON g.doc_id = r.doc_id LEFT JOIN head h ON h.doc_id = r.doc_id
"""

COMPONENTS = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS words FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(words[s:s + 4], ' ')) AS k
  FROM w, unnest(range(1, greatest(len(words) - 3, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS t(s)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingle a JOIN shingle b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(b, w.doc_id)) AS component_id
FROM w LEFT JOIN size ON size.doc_id = w.doc_id LEFT JOIN least ON a = w.doc_id
"""

SUBSTRINGS_OF_WORDS = f"""
WITH w AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
win AS (
  SELECT doc_id, s, md5_number(array_to_string(words[s:s + 19], ' ')) AS k
  FROM w, unnest(range(1, len(words) - 18)) AS t(s)),
later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + i AS p FROM later, range(0, 20) AS t(i)),
word AS (SELECT doc_id, p, words[p] AS word FROM w, unnest(range(1, len(words) + 1)) AS t(p)),
kept AS (
  SELECT word.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY word.p) FILTER (gone.p IS NULL) AS kept
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
