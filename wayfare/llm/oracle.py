"""DuckDB SQL for the queries that SQL can express. The others (trained
models, knapsack and bucket programs, XXH64, random projections) are tested
against brute force, a round trip or held-out accuracy."""

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (SELECT *, {LOWER.format(f'trim(line, {SPACES})')} AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Every word window of a text, and the words that repeated ones cover.
OP8 = f"""
WITH body AS (SELECT doc_id, source, coalesce(text, '') AS body, text FROM documents),
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w FROM body)),
windows AS (
  SELECT doc_id, i, word || chr(10) || lead(word, 1) OVER o || chr(10) || lead(word, 2) OVER o || chr(10)
         || lead(word, 3) OVER o || chr(10) || lead(word, 4) OVER o AS gram
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
tied AS (SELECT doc_id, i FROM windows WHERE gram IS NOT NULL
         QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM tied, range(0, 5) r(k) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, body, unnest(string_split(body, chr(10))) AS line FROM body),
full_lines AS (SELECT *, lower(trim(line, {SPACES})) AS key FROM lines WHERE trim(line, {SPACES}) <> ''),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
frequent AS (
  SELECT source, key FROM full_lines GROUP BY source, key HAVING count(DISTINCT row(doc_id, body)) >= 10),
removed AS (
  SELECT doc_id, sum(len(regexp_extract_all(l.key, '[^\\x20\\x09-\\x0D]+'))) AS n
  FROM full_lines l JOIN frequent f ON l.key = f.key AND l.source IS NOT DISTINCT FROM f.source
  GROUP BY doc_id),
measured AS (
  SELECT b.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(c.word_chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(b.body, '[#*$%&|<>]')) AS n_symbols, coalesce(d.n, 0) AS n_dup_lines,
         coalesce(v.n, 0) AS n_repeat_words, coalesce(r.n, 0)::BIGINT AS n_removed_words
  FROM body b LEFT JOIN counts c USING (doc_id) LEFT JOIN dups d USING (doc_id)
  LEFT JOIN covered v USING (doc_id) LEFT JOIN removed r USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - n_removed_words >= 10 AND n_words - n_removed_words >= 0.3 * n_words AS kept,
       n_removed_words
FROM judged
"""

# Every window of each length that an item has, in every document.
OP11_WORDS = LOWER.format("coalesce(text, '')")
OP11 = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({OP11_WORDS}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all({OP11_WORDS}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
places AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
           FROM iw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS body FROM places),
spots AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM dw, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
found AS (SELECT doc_id, i, k, item_id
          FROM (SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS body FROM spots) s
          JOIN windows USING (k, body)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM found)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.list, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

OP13_SHARE = "1 + (1000000000::HUGEINT * ({c} + 2)) // ({n} + 2 * {v})"
OP13 = f"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     {OP11_WORDS} AS body FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
size AS (SELECT lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept k USING (lang) GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs)
           LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
                  {OP13_SHARE.format(c='coalesce(c.c, 0)', n='g.n', v='s.v')} AS p
           FROM groups g JOIN size s USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
whole AS (SELECT lang, term, {OP13_SHARE.format(c='sum(c)', n='any_value(n)', v='any_value(v)')} AS q
          FROM counts JOIN size USING (lang) JOIN (SELECT lang, sum(n) AS n FROM groups GROUP BY lang) USING (lang)
          GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(f), 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source AS s1, y.source AS s2, (x.p - y.p) * (x.p - y.p) // (x.p + y.p) AS f
                     FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source) z
          ON z.lang = a.lang AND s1 = a.source AND s2 = b.source GROUP BY ALL),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
          FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE = {"op8_quality_rules": OP8, "op10_line_dedup": OP10, "op11_decontaminate": OP11, "op13_divergence": OP13}
