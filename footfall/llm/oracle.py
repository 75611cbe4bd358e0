"""The corpus queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

# Frequent function words of the four languages.
STOP_WORDS = """a an and are as by for from in is it of on or that the this to was with
au avec ce dans de des du elle en est et la le les pas pour que qui sur un une
auf aus bei das dem den der die ein eine ist mit nicht sich und von zu
como con del el los no para por se su una"""

_STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS.split())

OP1 = rf"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM again) GROUP BY r),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
         CAST(length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_upper
  FROM base LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         concat_ws(',',
           CASE WHEN n_words > 0 AND (1000 * word_chars < 1500 * n_words
                                      OR 1000 * word_chars > 18000 * n_words) THEN 'word_length' END,
           CASE WHEN word_chars > 0 AND 1000 * n_symbols > 100 * word_chars THEN 'symbols' END,
           CASE WHEN word_chars > 0 AND 1000 * n_upper > 500 * word_chars THEN 'shouting' END,
           CASE WHEN n_words > 0 AND 1000 * n_stop_words < 20 * n_words THEN 'stop_words' END,
           CASE WHEN n_lines > 0 AND 1000 * n_dup_lines > 500 * n_lines THEN 'same_lines' END,
           CASE WHEN n_words > 0 AND 1000 * n_repeat_words > 300 * n_words THEN 'same_words' END
         ) AS broken_rules
  FROM counts)
SELECT *, NOT base_failed AND broken_rules = '' AS kept FROM judged
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM (SELECT *, least(13, len(w)) AS m FROM b WHERE len(w) > 0))),
doc_windows AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d JOIN (SELECT DISTINCT m FROM item_windows) ON len(w) >= m)),
hits AS (SELECT r, m, i, item_id FROM doc_windows JOIN item_windows USING (m, g)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP7 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (
  SELECT x.r AS a, y.r AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.r < y.r GROUP BY ALL),
linked AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)),
links AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (
  SELECT r AS a, r AS b FROM d
  UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b)
SELECT x.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(y.doc_id) AS component_id
FROM reached JOIN d x ON x.r = reached.a JOIN d y ON y.r = reached.b LEFT JOIN sizes ON sizes.r = x.r
GROUP BY x.r, x.doc_id
"""

OP9 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT t, min(page_id) AS one FROM p GROUP BY t)
SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    (CAST('0x' || substr(h, CAST(5 * (k // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT))
    & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = one THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> one THEN one END AS refers_to
FROM p JOIN firsts USING (t)
"""

OP12 = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
         ('0x' || h[17:24])::BIGINT % 100 AS d3, ('0x' || h[25:32])::BIGINT % 100 AS d4 FROM units
), cut AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d3 >= 90 THEN 'plain'
              WHEN d4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM cut
"""

SQL = {
    "op12_fill_in_middle": OP12,
    "op9_warc": OP9,
    "op4_decontamination": OP4,
    "op7_jaccard_join": OP7,
    "op1_quality_rules": OP1,
}
