"""SQL twins of the operators that SQL can express, written from their definitions."""

_CLOSURE = """reach(id, other) AS (
  SELECT id, id FROM nodes UNION SELECT reach.id, l.b FROM reach JOIN links l ON l.a = reach.other),
components AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

NEAR_DUPLICATE_TEXTS = rf"""WITH RECURSIVE texts AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
nodes AS (SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM texts),
words AS (SELECT id, len(s) AS n, unnest(s) AS g FROM nodes),
met AS (SELECT x.id AS a, y.id AS b, count(*) AS shared, any_value(x.n + y.n) AS total
  FROM words x JOIN words y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
links AS (SELECT a, b FROM met WHERE 100 * shared >= 85 * (total - shared)),
{_CLOSURE}
SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, id = component_id AS kept
FROM nodes JOIN components USING (id)"""

NEAR_DUPLICATE_VECTORS = f"""WITH RECURSIVE nodes AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
fine AS (SELECT * FROM nodes WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT x.id AS a, y.id AS b FROM fine x JOIN fine y ON x.id <> y.id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
{_CLOSURE}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept
FROM nodes JOIN components USING (id)"""

# Fixed values, as in the definition of the rules.
_PHRASES = (
    "all rights reserved|accept cookies|we use cookies|cookie policy|privacy policy|terms of service|terms of use|enable javascript|"
    "javascript is disabled|click here|lorem ipsum|subscribe to our|sign up for our|licensed under|released under the|powered by|"
    "skip to content")
_MENU = (
    "home|menu|login|log in|sign in|sign up|register|search|next|previous|back to top|read more|share|contact|contact us|about|"
    "about us|sitemap")

QUALITY = rf"""WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts WHERE len(w) > 2)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, sum(n) AS n FROM (
  SELECT r, least(3, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3)) AS n FROM again) GROUP BY r),
single AS (SELECT r, unnest(list_distinct(lines)) AS x FROM texts),
judged AS (SELECT r, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n, len(regexp_extract_all(x, '[#*$%&|<>]')) AS symbols,
    len(list_filter(string_split(x, ' ')[2:-2], lambda v: v IN ('|', '»', '›', '•', '·', '>'))) AS separators,
    len(regexp_extract_all(x, '[!?]{{2,}}')) AS marks FROM single),
survivors AS (SELECT r, sum(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))) AS chars FROM judged WHERE NOT (
  (symbols >= 3 AND 2 * symbols > n) OR (separators >= 2 AND 5 * separators >= n) OR 10 * marks > 3 * n
  OR regexp_matches(x, '^\s*(?:\S+\s+)?\S*[^\s\p{{Po}}\p{{Pe}}\p{{Pf}}"]\s*$') OR NOT regexp_matches(x, '[\p{{L}}\p{{N}}]')
  OR (length(x) <= 240 AND regexp_matches(x, '(?i)\b(?:{_PHRASES})|^\s*(?:{_MENU})[\s\p{{P}}\p{{S}}]*$'))) GROUP BY r),
counts AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(survivors.chars, 0) AS left_chars
  FROM texts LEFT JOIN covered USING (r) LEFT JOIN survivors USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND left_chars >= 0.6::DOUBLE * word_chars AS kept FROM counts"""

# crc32 of a key's UTF-8 bytes from the polynomial's table; `crc` needs the columns `key` and `tab`.
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(key))),
    lambda i: CAST('0x' || substr(hex(encode(key)), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""

SPELLING_VARIANTS = f"""WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(coalesce(text, ''),
    '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
keys AS (SELECT run, doc || ':' || run AS key, count(*) AS n FROM runs WHERE length(run) > 6 GROUP BY ALL),
hashed AS (SELECT run, n, {_CRC} AS h FROM keys, crc_table),
damaged AS (SELECT n, CASE WHEN h % 31 <> 0 THEN run
    ELSE substr(run, 1, h % length(run)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) END AS word FROM hashed),
vocabulary AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) > 6 GROUP BY word HAVING sum(n) > 1),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary),
cuts AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM places),
pairs AS (SELECT x.word AS word, y.word AS other FROM cuts x JOIN cuts y ON x.i = y.i AND x.cut = y.cut AND x.word <> y.word
  UNION SELECT c.word, v.word FROM cuts c JOIN vocabulary v ON c.cut = v.word
  UNION SELECT v.word, c.word FROM cuts c JOIN vocabulary v ON c.cut = v.word),
near AS (SELECT p.word, p.other, v.n AS other_n FROM pairs p JOIN vocabulary v ON v.word = p.other),
best AS (SELECT word, count(*) AS n_near, min({{'m': -other_n, 'w': other}}) AS b FROM near GROUP BY word),
judged AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 10 * v.n THEN b.w END AS form,
    CASE WHEN -b.m >= 10 * v.n THEN -b.m END AS form_n FROM vocabulary v LEFT JOIN best USING (word)),
chain(word, root) AS (SELECT word, word FROM judged
  UNION ALL SELECT chain.word, judged.form FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NOT NULL)
SELECT judged.word, form, chain.root, n, n_near, form_n FROM judged JOIN chain USING (word)
WHERE NOT EXISTS (SELECT 1 FROM judged j WHERE j.word = chain.root AND j.form IS NOT NULL)"""

# States 0 to 3: nothing yet, after system, after user, after assistant. `jump` holds the inserts between two states.
TURN_REPAIR = rf"""WITH RECURSIVE {_CRC_TABLE},
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
deeds AS (SELECT *, {_CRC} % 20 AS deed FROM given, crc_table),
after AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, turn, CASE WHEN deed = 4 THEN 'user' ELSE role END AS role,
    CASE deed WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, deed,
    unnest(range(CASE deed WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM deeds),
ordered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM after),
placed AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth FROM ordered),
coded AS (SELECT c, i, turn, role, text, substr(role, 1, 1) AS a, lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY i) AS p,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN nth > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 't' ELSE 'k' END AS fault FROM placed),
jump(q, r, edits, lines) AS (VALUES (0, 0, '', []), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']),
  (1, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
  (1, 3, 'II', ['user:', 'assistant:'])),
due(q, r, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
kept(q, r, a) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
states(c, i, q, best) AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} FROM coded
  UNION ALL
  SELECT c, i, q, min(best) FROM (
    SELECT s.c, n.i, m.q, {{'cost': s.best.cost + 5 * len(j.edits) + m.cost, 'audit': s.best.audit || j.edits || m.edit,
        'lines': list_concat(s.best.lines, j.lines, CASE WHEN m.edit = 'D' THEN [] ELSE [m.role || ':' || n.text] END)}} AS best
    FROM states s JOIN coded n ON n.c = s.c AND n.i = s.i + 1 JOIN jump j ON j.q = s.q
    CROSS JOIN LATERAL (
      SELECT j.r AS q, 'D' AS edit, 2 AS cost, '' AS role
      UNION ALL SELECT k.r, 'K', CASE n.fault WHEN 't' THEN 5 ELSE 0 END, n.role FROM kept k
        WHERE k.q = j.r AND k.a = n.a AND n.fault IN ('k', 't')
      UNION ALL SELECT d.r, 'R', CASE n.fault WHEN 't' THEN 6 ELSE 1 END, d.role FROM due d
        WHERE d.q = j.r AND n.fault IN ('k', 't')) m) GROUP BY c, i, q),
sizes AS (SELECT c, max(i) AS n FROM coded GROUP BY c),
ends AS (SELECT s.c, min({{'cost': s.best.cost + 5 * len(j.edits), 'audit': s.best.audit || j.edits,
    'lines': list_concat(s.best.lines, j.lines)}}) AS best
  FROM states s JOIN sizes z ON z.c = s.c AND z.n = s.i JOIN jump j ON j.q = s.q AND (j.r = 3 OR (j.q = 0 AND j.r = 0)) GROUP BY s.c),
facts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (p || a NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY c),
ids AS (SELECT DISTINCT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c FROM deeds)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN facts USING (c) LEFT JOIN ends USING (c)"""

ORACLE_SQL = {
    "op11_spelling_variants": SPELLING_VARIANTS, "op13_turn_repair": TURN_REPAIR,
    "op6_graph_near_dedup": NEAR_DUPLICATE_VECTORS, "op9_quality_rules": QUALITY, "op10_minhash_near_dedup": NEAR_DUPLICATE_TEXTS,
}
