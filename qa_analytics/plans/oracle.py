"""ANSI SQL twins of the catalogue's queries, for any SQL engine over the same tables."""

from ..functions.word_lists import (
    ADVANCED_TERMS, CODE_SIGNS, INTENSITY_WORDS, NEGATIONS, QUESTION_SIGNS, SENTIMENT_WORDS, SPLIT_FORMS, STOP_WORDS,
    TECHNICAL_TERMS,
)
from .catalog import ALL_TABLES


def _quoted(values):
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


_EVENTS = """
q_events AS (
  SELECT event_id AS question_id, event_type || ' event of user ' || user_id AS title,
    '/questions/' || event_id || '/' || event_type AS url, props AS summary,
    [event_type, 'k' || k] AS tags, 'user' || user_id AS author_name,
    CAST(floor(value * 10) AS BIGINT) AS author_reputation, '/users/' || user_id AS author_profile_url,
    CAST(ts AS TIMESTAMP) AS publication_date, CAST(floor(value) AS BIGINT) AS view_count,
    k - 50 AS vote_count, k % 5 AS answer_count
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

_ORDERS = """
q_orders AS (
  SELECT o_orderkey AS question_id, CAST(o_orderdate AS TIMESTAMP) AS publication_date,
    [lower(o_orderpriority), o_orderstatus, 'price-' || CAST(floor(o_totalprice / 10000) AS BIGINT)] AS tags,
    price AS view_count, price % 100 - 50 AS vote_count, price % 4 AS answer_count
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders))"""

_DOCS = """
q_docs AS (
  SELECT doc_id AS question_id, split_part(text, chr(10), 1) AS title,
    substr(text, length(split_part(text, chr(10), 1)) + 2) AS summary FROM documents)"""

_STORE = _EVENTS + """,
existing AS (
  SELECT *, TIMESTAMP '2024-01-21' AS stored_at, TIMESTAMP '2024-01-21' AS last_updated
  FROM q_events WHERE publication_date < TIMESTAMP '2024-01-21'),
recent AS (SELECT * FROM q_events WHERE publication_date >= TIMESTAMP '2024-01-11'),
incoming AS (
  SELECT * REPLACE (vote_count + 1 AS vote_count), question_id * 2 AS seq FROM recent
  UNION ALL
  SELECT * REPLACE (vote_count + 100 AS vote_count), question_id * 2 + 1 AS seq FROM recent WHERE tags[1] = 'purchase'),
newest AS (SELECT * EXCLUDE (seq), TIMESTAMP '2024-02-01' AS stored_at, TIMESTAMP '2024-02-01' AS last_updated
  FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY seq DESC) AS rn FROM incoming) WHERE rn = 1),
fresh AS (SELECT * EXCLUDE (rn) FROM newest),
unseen AS (SELECT * FROM incoming WHERE question_id NOT IN (SELECT question_id FROM existing)),
known AS (SELECT * FROM incoming WHERE question_id IN (SELECT question_id FROM existing)),
authors0 AS (
  SELECT author_name, arg_max(author_reputation, question_id) AS reputation,
    arg_max(author_profile_url, question_id) AS profile_url, TIMESTAMP '2024-01-21' AS last_seen,
    count(*) AS question_count, TIMESTAMP '2024-01-21' AS first_seen
  FROM existing GROUP BY author_name),
everyone AS (
  SELECT author_name, arg_max(author_reputation, question_id) AS reputation,
    arg_max(author_profile_url, question_id) AS profile_url, TIMESTAMP '2024-01-21' AS last_seen,
    count(*) AS question_count, TIMESTAMP '2024-01-21' AS first_seen
  FROM q_events GROUP BY author_name),
versions AS (
  SELECT * REPLACE (vote_count + 1 AS vote_count), question_id * 2 AS seq FROM q_events
  UNION ALL
  SELECT * REPLACE (vote_count + 100 AS vote_count), question_id * 2 + 1 AS seq FROM q_events WHERE tags[1] = 'purchase')"""

_QUESTION_OUT = """question_id, title, url, summary, array_to_string(tags, ',') AS tags, author_name, author_reputation,
  author_profile_url, publication_date, view_count, vote_count, answer_count, stored_at, last_updated"""

_PLAIN_OUT = _QUESTION_OUT.replace(", stored_at, last_updated", "")

_TRENDS = """,
uses AS (SELECT publication_date AS d, unnest(tags) AS tag FROM {source} WHERE publication_date IS NOT NULL),
counted AS (
  SELECT tag, count(*) AS total_questions,
    count(*) FILTER (d >= {at} - INTERVAL 7 DAY) AS last_week,
    count(*) FILTER (d >= {at} - INTERVAL 30 DAY) AS last_month,
    count(*) FILTER (d >= {at} - INTERVAL 90 DAY) AS last_quarter,
    count(*) FILTER (d >= {at} - INTERVAL 365 DAY) AS last_year,
    count(*) FILTER (d >= {at} - INTERVAL 60 DAY AND d < {at} - INTERVAL 30 DAY) AS older
  FROM uses GROUP BY tag),
trends AS (
  SELECT * EXCLUDE (older), CASE WHEN older > 0
    THEN round(CAST(last_month - older AS DOUBLE) / older * 100, 6) ELSE 0.0 END AS growth_rate FROM counted)"""

_ORDER_TRENDS = _ORDERS + _TRENDS.format(source="q_orders", at="TIMESTAMP '2001-08-01'")
_EVENT_TRENDS = _EVENTS + _TRENDS.format(source="q_events", at="TIMESTAMP '2024-02-05'")

# ---- text ------------------------------------------------------------------

_COMBINED = r"regexp_replace(title || ' ' || summary, '^\s+|\s+$', '', 'g')"


def _clean(text):
    return (rf"regexp_replace(regexp_replace(regexp_replace(lower({text}), '<[^>]+>', '', 'g'), "
            rf"'http\S+|www\S+', '', 'g'), '[^a-zA-Z\s]', '', 'g')")


def _tokens(text):
    text = _clean(text)
    for form, parts in SPLIT_FORMS.items():
        text = rf"regexp_replace({text}, '\b{form}\b', '{parts}', 'g')"
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: length(w) > 2 AND w NOT IN ({_quoted(STOP_WORDS)}))"


# Spelled out again, so that a wrong entry of the library's lists shows.
_IRREGULAR = """men man analyses analysis appendices appendix axes axis bacteria bacterium bases base calves calf children child crises
crisis criteria criterion data data diagnoses diagnosis dice die feet foot geese goose halves half hypotheses hypothesis indices
index knives knife leaves leaf lice louse lives life loaves loaf matrices matrix mice mouse movies movie oxen ox parentheses
parenthesis phenomena phenomenon quizzes quiz scarves scarf schemata schema selves self sheaves sheaf shelves shelf stimuli
stimulus syntheses synthesis teeth tooth theses thesis thieves thief ties tie vertices vertex wives wife wolves wolf caches cache
axles axle buses bus gases gas lenses lens aliases alias statuses status viruses virus bonuses bonus sizes size prizes prize
headaches headache mazes maze zombies zombie cookies cookie pies pie lies lie dies die""".split()
_NO_PLURALS = """abdomen acumen alias always amen atlas bias canvas chaos christmas cosmos gas iris kudos lens mathematics news omen
pandas perhaps physics regimen series species specimen stamen sometimes thanks towards whereas yes yours afterwards besides
nowadays""".split()


def _lemmas(tokens):
    irregular = "map([" + _quoted(_IRREGULAR[::2]) + "], [" + _quoted(_IRREGULAR[1::2]) + "])"
    return rf"""list_filter(list_transform({tokens}, lambda w: CASE
  WHEN w IN ({_quoted(_IRREGULAR[::2])}) THEN {irregular}[w] WHEN w IN ({_quoted(_NO_PLURALS)}) THEN w
  WHEN regexp_matches(w, '.(ss|ch|sh)es$') THEN w[:-3] WHEN regexp_matches(w, '.(x|z)es$') THEN w[:-3]
  WHEN regexp_matches(w, '..ies$') THEN w[:-4] || 'y' WHEN regexp_matches(w, '..men$') THEN w[:-4] || 'man'
  WHEN regexp_matches(w, '(s|u|i)s$') THEN w WHEN regexp_matches(w, '...s$') THEN w[:-2] ELSE w END), lambda w: length(w) > 1)"""


def _corpus(*sources):
    parts = {
        "title": "SELECT 'title' AS source, question_id AS doc, title AS text FROM q_docs",
        "summary": "SELECT 'summary' AS source, question_id AS doc, summary AS text FROM q_docs",
        "combined": f"SELECT 'combined' AS source, question_id AS doc, {_COMBINED} AS text FROM q_docs",
    }
    return _DOCS + ",\ncorpus AS (" + " UNION ALL ".join(parts[s] for s in sources) + ")"


def _keywords(sources, limits):
    features = {"title": 50, "summary": 50, "combined": 100}
    case = lambda numbers: "CASE source " + " ".join(f"WHEN '{s}' THEN {numbers[s]}" for s in sources) + " END"
    return f"""WITH {_corpus(*sources)},
docs AS (SELECT * FROM (SELECT source, doc, {_lemmas(_tokens('text'))} AS tokens FROM corpus) WHERE len(tokens) > 0),
terms AS (
  SELECT source, doc, unnest(list_concat(tokens,
    [tokens[i] || ' ' || tokens[i + 1] for i in range(1, len(tokens))])) AS term FROM docs),
tf AS (SELECT source, doc, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT source, count(*) AS n FROM docs GROUP BY source),
stats AS (SELECT source, term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY ALL),
bounds AS (SELECT *, greatest(1, least(2, floor(n * 0.1))) AS min_df,
  CASE WHEN n <= 5 THEN 0.95::DOUBLE WHEN n <= 10 THEN 0.9::DOUBLE ELSE 0.8::DOUBLE END * n AS max_df FROM sizes),
kept AS (
  SELECT source, term, n, ln(CAST(n + 1 AS DOUBLE) / (df + 1)) + 1 AS idf,
    row_number() OVER (PARTITION BY source ORDER BY total DESC, term) AS place
  FROM stats JOIN bounds USING (source) WHERE df >= min_df AND df <= max_df AND max_df >= min_df),
weights AS (
  SELECT source, doc, term, n, tf * idf AS w FROM tf JOIN kept USING (source, term) WHERE place <= {case(features)}),
shares AS (SELECT source, term, n, w / sqrt(sum(w * w) OVER (PARTITION BY source, doc)) AS share FROM weights),
scores AS (SELECT source, term, sum(share) / max(n) AS score FROM shares GROUP BY source, term),
places AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, term) AS rank FROM scores)
SELECT source, rank, term, round(score, 6) AS score,
  CASE WHEN score > 0.5 THEN 'Très important' WHEN score > 0.2 THEN 'Important'
    WHEN score > 0.1 THEN 'Modéré' ELSE 'Faible' END AS significance
FROM places WHERE rank <= {case(limits)}"""


def _values(rows):
    return ", ".join(f"('{w}', {v})" for w, v in rows.items())


_SCALING = {w: v for w, v in INTENSITY_WORDS.items() if w not in SENTIMENT_WORDS}

_POLARITY = rf"""WITH {_corpus('title', 'summary', 'combined')},
lexicon(word, polarity) AS (SELECT col0, col1::DOUBLE FROM (VALUES {_values(SENTIMENT_WORDS)})),
scaling(word, intensity) AS (SELECT col0, col1::DOUBLE FROM (VALUES {_values(_SCALING)})),
texts AS (
  SELECT source, doc, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}'']+'), lambda w: w <> '') AS tokens
  FROM corpus WHERE regexp_matches(text, '\S')),
placed AS (SELECT source, doc, tokens, unnest(tokens) AS word, unnest(range(1, len(tokens) + 1)) AS i FROM texts),
found AS (
  SELECT source, doc, polarity, intensity,
    greatest(-1.0::DOUBLE, least(1.0::DOUBLE, polarity * coalesce(intensity, 1.0))) AS scaled,
    CASE WHEN i > 1 THEN tokens[i - 1] END AS before, CASE WHEN i > 2 THEN tokens[i - 2] END AS before2
  FROM placed JOIN lexicon USING (word)
  LEFT JOIN scaling ON i > 1 AND tokens[i - 1] = scaling.word),
polar AS (
  SELECT source, doc, avg(CASE WHEN before IN ({_quoted(NEGATIONS)})
    OR (intensity IS NOT NULL AND before2 IN ({_quoted(NEGATIONS)})) THEN scaled * -0.5 ELSE scaled END) AS polarity
  FROM found GROUP BY source, doc),
totals AS (SELECT source, count(*) FILTER (regexp_matches(text, '\S')) AS total FROM corpus GROUP BY source),
summed AS (
  SELECT source, count(*) FILTER (polarity > 0.1) AS positive, count(*) FILTER (polarity < -0.1) AS negative,
    sum(polarity) AS polarity FROM polar GROUP BY source),
summary AS (
  SELECT source, coalesce(positive, 0) AS positive, coalesce(negative, 0) AS negative,
    total - coalesce(positive, 0) - coalesce(negative, 0) AS neutral,
    round(CASE WHEN total > 0 THEN coalesce(polarity, 0.0) / total ELSE 0.0 END, 6) AS average, total
  FROM totals LEFT JOIN summed USING (source))
"""


def _quality(technical, advanced, questions, codes, select, source="quality"):
    like = lambda terms: " OR ".join("contains(t, '" + x + "')" for x in terms)
    present = " + ".join(f"CAST(contains(t, '{x}') AS BIGINT)" for x in advanced)
    return rf"""WITH {_DOCS},
rows AS (
  SELECT title, summary, lower(title || ' ' || summary) AS t FROM q_docs),
sums AS (
  SELECT count(*) AS n,
    count(*) FILTER (length(regexp_replace(summary, '^\s+|\s+$', '', 'g')) > 50) AS complete,
    CAST(sum(len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> ''))) AS BIGINT) AS words,
    CAST(sum(len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w IN ({_quoted(technical)})))) AS BIGINT) AS technical,
    CAST(sum({present}) AS BIGINT) AS advanced,
    count(*) FILTER (({like(questions)}) AND ({like(codes)})) AS clear
  FROM rows),
quality AS (
  SELECT round(CAST(complete AS DOUBLE) / n * 100, 6) AS summary_completeness,
    round(CAST(technical AS DOUBLE) / greatest(words, 1) * 100, 6) AS technical_word_ratio,
    round(CAST(words AS DOUBLE) / n, 6) AS avg_words_per_question, technical AS technical_term_count,
    round(CAST(advanced AS DOUBLE) / n * 100, 6) AS technical_depth,
    round(CAST(clear AS DOUBLE) / n * 100, 6) AS clear_questions_ratio, clear AS questions_with_context
  FROM sums)
SELECT {select} FROM {source}"""


_DEFAULT_QUALITY = (TECHNICAL_TERMS, ADVANCED_TERMS, QUESTION_SIGNS, CODE_SIGNS)
_FREQUENT_QUALITY = (["the", "and", "with", "le", "der"], ["ation", "onst", "er th"], ["what", "wh", "?"], ["ing", "ou"])


def _band(metric, bounds, names):
    cases = " ".join(f"WHEN {metric} > {b} THEN '{n}'" for b, n in zip(bounds, names))
    return f"SELECT '{metric}' AS metric, {metric} AS value, CASE {cases} ELSE '{names[-1]}' END AS band FROM quality"


_BANDS = " UNION ALL ".join([
    _band("summary_completeness", [80, 60, 40], ["Excellent", "Bon", "Modéré", "Faible"]),
    _band("technical_word_ratio", [30, 20, 10], ["Très technique", "Technique", "Modérément technique", "Peu technique"]),
    _band("avg_words_per_question", [100, 50, 30], ["Très détaillé", "Détaillé", "Standard", "Concis"]),
    _band("technical_depth", [20, 10, 5], ["Très avancé", "Avancé", "Intermédiaire", "Basique"]),
    _band("clear_questions_ratio", [80, 60, 40], ["Excellent", "Bon", "Modéré", "Améliorable"]),
])


def _patterns(source, unit, expression):
    mean = lambda c: f"round_even(avg({c}) * 100, 0) / 100"
    return f"""WITH {_EVENTS if source == 'q_events' else _ORDERS}
SELECT {expression} AS {unit}, count(vote_count) AS votes_count, {mean('vote_count')} AS votes_mean,
  {mean('view_count')} AS views_mean, {mean('answer_count')} AS answers_mean
FROM {source} WHERE publication_date IS NOT NULL GROUP BY 1"""


def _summary(column, *parts):
    every = {
        "mean": f"round(avg({column}), 6) AS mean", "median": f"round(median({column}), 6) AS median",
        "max": f"CAST(max({column}) AS DOUBLE) AS max", "min": f"CAST(min({column}) AS DOUBLE) AS min",
        "std": f"round(stddev_pop({column}), 6) AS std",
        "zero": f"round(CAST(count(*) FILTER ({column} = 0) AS DOUBLE) / count(*) * 100, 6)",
    }
    return ", ".join(every.get(p, p) for p in parts), every["zero"]


# ---- writes ----------------------------------------------------------------

_UPDATES = """,
updates AS (
  SELECT author_name, count(*) AS rows, arg_max(author_reputation, seq) AS reputation,
    arg_max(author_profile_url, seq) AS profile_url FROM {batch}
  WHERE author_name IS NOT NULL AND author_name NOT IN ('', 'Unknown') GROUP BY author_name)"""


def _authors(batch, join):
    return f"""WITH {_STORE}{_UPDATES.format(batch=batch)}
SELECT author_name, coalesce(u.reputation, a.reputation) AS reputation,
  coalesce(u.profile_url, a.profile_url) AS profile_url,
  CASE WHEN u.rows IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE a.last_seen END AS last_seen,
  coalesce(a.question_count, 0) + coalesce(u.rows, 0) AS question_count,
  coalesce(a.first_seen, TIMESTAMP '2024-02-01') AS first_seen
FROM authors0 a {join} JOIN updates u USING (author_name)"""


_APPENDED = f"""WITH {_STORE}
SELECT {_QUESTION_OUT} FROM existing
UNION ALL SELECT {_QUESTION_OUT} FROM fresh WHERE question_id NOT IN (SELECT question_id FROM existing)"""

_UPSERTED = f"""WITH {_STORE}
SELECT {_QUESTION_OUT} FROM existing WHERE question_id NOT IN (SELECT question_id FROM fresh)
UNION ALL SELECT {_QUESTION_OUT} FROM fresh"""

_METRICS = _STORE + """,
per_author AS (
  SELECT mode, author_name, count(*) AS n, author_name IN (SELECT author_name FROM authors0) AS old FROM (
    SELECT 'upsert' AS mode, author_name FROM incoming UNION ALL SELECT 'update', author_name FROM known
    UNION ALL SELECT 'append-only', author_name FROM unseen) GROUP BY mode, author_name),
by_mode AS (
  SELECT mode, CASE WHEN mode = 'update' THEN 0 ELSE count(*) FILTER (NOT old) END AS authors_new,
    CASE WHEN mode = 'update' THEN coalesce(sum(n) FILTER (old), 0)
      ELSE sum(n) - count(*) FILTER (NOT old) END AS authors_updated FROM per_author GROUP BY mode),
stored AS (
  SELECT 'upsert' AS mode, count(*) AS questions_stored FROM incoming
  UNION ALL SELECT 'update', count(*) FROM known UNION ALL SELECT 'append-only', count(*) FROM unseen),
metrics AS (
  SELECT mode, (SELECT count(*) FROM incoming) AS questions_attempted, questions_stored,
    CAST(coalesce(authors_new, 0) AS BIGINT) AS authors_new, CAST(coalesce(authors_updated, 0) AS BIGINT) AS authors_updated
  FROM stored LEFT JOIN by_mode USING (mode))"""


def _refresh(size, dry_run=False):
    return _STORE + f""",
batches AS (SELECT question_id, (row_number() OVER (ORDER BY question_id) - 1) // {size} + 1 AS batch_no FROM existing),
found AS (
  SELECT question_id, count(*) AS found, count(*) FILTER (author_name IN (SELECT author_name FROM authors0)) AS authors
  FROM incoming GROUP BY question_id),
refreshed AS (
  SELECT CAST(batch_no AS BIGINT) AS batch_no, count(*) AS processed,
    CAST(coalesce(sum(found), 0) AS BIGINT) AS updated, CAST(0 AS BIGINT) AS errors,
    CASE WHEN coalesce(sum(found), 0) = 0 THEN count(*) ELSE 0 END AS skipped,
    CAST({'0' if dry_run else 'coalesce(sum(authors), 0)'} AS BIGINT) AS authors_updated
  FROM batches LEFT JOIN found USING (question_id) GROUP BY batch_no),
rollup AS (
  SELECT CAST(sum(processed) AS BIGINT) AS processed, CAST(sum(updated) AS BIGINT) AS updated,
    CAST(sum(errors) AS BIGINT) AS errors, CAST(sum(skipped) AS BIGINT) AS skipped,
    CAST(sum(authors_updated) AS BIGINT) AS authors_updated, count(*) AS batches_completed,
    round(sum(updated) / sum(processed) * 100, 6) AS success_rate FROM refreshed)"""


# ---- ingest, logs ----------------------------------------------------------

_BODY = "replace(replace(replace(regexp_replace({0}, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_PAYLOAD_BODY = _BODY.format("'<p>' || title || ' &lt;b&gt; &amp;lt; <code>' || repeat(summary, 50) || '</code></p>'")
_CUT = "CASE WHEN length({0}) > 500 THEN substr({0}, 1, 500) || '...' ELSE {0} END"

_OUTCOMES = """
outcomes AS (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN 'passed' WHEN event_type = 'purchase' THEN 'failed'
      WHEN event_type = 'error' THEN 'error' ELSE 'skipped' END AS outcome,
    'test_' || event_type || '_' || event_id AS name,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN round(value, 2) ELSE 0.0 END AS duration
  FROM events)"""


def _log_rollup(total):
    rates = ", ".join(f"round(CAST({o} AS DOUBLE) / total * 100, 6) AS {o}_rate" for o in ("passed", "failed", "error", "skipped"))
    return f"""WITH {_OUTCOMES},
counts AS (
  SELECT count(*) FILTER (outcome = 'passed') AS passed, count(*) FILTER (outcome = 'failed') AS failed,
    count(*) FILTER (outcome = 'error') AS error, count(*) FILTER (outcome = 'skipped') AS skipped,
    min(duration) FILTER (outcome IN ('passed', 'failed')) AS fastest,
    max(duration) FILTER (outcome IN ('passed', 'failed')) AS slowest,
    (SELECT round(sum(value), 2) FROM events) AS total_duration FROM outcomes),
totals AS (SELECT *, {total} AS total FROM counts)
SELECT *, {rates}, round(total / total_duration, 6) AS tests_per_second,
  error > 0 AS fix_errors, failed > 0 AS fix_failures, skipped > passed / 4 AS many_skipped,
  total_duration > 60 AS slow_run, failed = 0 AND error = 0 AS active_tests_pass,
  failed = 0 AND error = 0 AND skipped = 0 AS all_tests_pass FROM totals"""


_JSON_FIELDS = """
docs AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
fields AS (
  SELECT unnest(['event_id', 'who.user', 'who.props.k', 'mixed', 'list', 'type', 'none', 'flag', 'share']) AS field_path,
    unnest(['int', 'int', 'int', CASE WHEN k < 50 THEN 'int' ELSE 'str' END,
      CASE WHEN k < 30 THEN 'Array[empty]' WHEN k < 60 THEN 'Array[int]' ELSE 'Array[str]' END,
      'str', 'NoneType', 'bool', 'float']) AS type FROM docs)"""

ORACLE_SQL = {
    # tags
    "tag_statistics": f"""WITH {_ORDERS}
SELECT tag, count(*) AS count, round(avg(vote_count), 6) AS avg_votes, round(avg(view_count), 6) AS avg_views
FROM (SELECT unnest(tags) AS tag, vote_count, view_count FROM q_orders) GROUP BY tag ORDER BY count DESC, tag LIMIT 50""",
    "tag_frequency": f"""WITH {_ORDERS}
SELECT tag, count(*) AS count FROM (SELECT unnest(tags) AS tag FROM q_orders) GROUP BY tag ORDER BY count DESC, tag LIMIT 20""",
    "tag_summary": f"""WITH {_ORDERS}
SELECT (SELECT count(DISTINCT tag) FROM (SELECT unnest(tags) AS tag FROM q_orders)) AS total_unique_tags,
  CAST(sum(len(tags)) AS BIGINT) AS total_tags, count(*) AS total_questions,
  round(CAST(sum(len(tags)) AS DOUBLE) / count(*), 6) AS average_tags_per_question FROM q_orders""",
    "tag_trends": f"WITH {_ORDER_TRENDS} SELECT * FROM trends",
    "tag_trends_events": f"WITH {_EVENT_TRENDS} SELECT * FROM trends",
    "trending_tags": f"WITH {_ORDER_TRENDS} SELECT * FROM trends ORDER BY growth_rate DESC, last_month DESC, tag LIMIT 20",
    "top_tags": f"WITH {_ORDER_TRENDS} SELECT * FROM trends ORDER BY total_questions DESC, tag LIMIT 20",
    "declining_tags": f"WITH {_ORDER_TRENDS} SELECT * FROM trends WHERE growth_rate < 0",
    "batch_members": f"""WITH {_EVENTS}
SELECT DISTINCT 'tag' AS kind, unnest(tags) AS name FROM q_events
UNION SELECT 'author', author_name FROM q_events WHERE author_name <> ''""",
    # temporal
    "hourly_patterns": _patterns("q_events", "hour", "hour(publication_date)"),
    "weekday_patterns": _patterns("q_events", "day_of_week", "isodow(publication_date) - 1"),
    "monthly_patterns": _patterns("q_orders", "month", "month(publication_date)"),
    "activity_peaks": f"""WITH {_EVENTS},
hours AS (SELECT hour(publication_date) AS h, count(*) AS n FROM q_events GROUP BY 1),
days AS (SELECT isodow(publication_date) - 1 AS w, count(*) AS n FROM q_events GROUP BY 1),
best AS (SELECT (SELECT h FROM hours ORDER BY n DESC, h LIMIT 1) AS peak_hour,
  (SELECT w FROM days ORDER BY n DESC, w LIMIT 1) AS peak_day)
SELECT peak_hour, peak_day,
  ['Lundi', 'Mardi', 'Mercredi', 'Jeudi', 'Vendredi', 'Samedi', 'Dimanche'][peak_day + 1] AS peak_day_name,
  (SELECT count(*) FROM q_events) AS total_questions_analyzed FROM best""",
    "date_range": f"""WITH {_EVENTS}
SELECT strftime(min(publication_date), '%Y-%m-%dT%H:%M:%S.%f') AS start,
  strftime(max(publication_date), '%Y-%m-%dT%H:%M:%S.%f') AS end FROM q_events""",
    # general
    "vote_stats": f"WITH {_EVENTS} SELECT {_summary('vote_count', 'mean', 'median', 'max', 'std')[0]} FROM q_events",
    "view_stats": f"WITH {_ORDERS} SELECT {_summary('view_count', 'mean', 'median', 'max', 'std')[0]} FROM q_orders",
    "answer_stats": f"""WITH {_EVENTS} SELECT {_summary('answer_count', 'mean', 'median', 'max')[0]},
  {_summary('answer_count')[1]} AS unanswered_rate FROM q_events""",
    "store_stats": f"""WITH {_STORE}
SELECT count(*) AS questions, (SELECT count(*) FROM everyone) AS authors, CAST(0 AS BIGINT) AS analyses,
  min(publication_date) AS first_date, max(publication_date) AS last_date FROM q_events""",
    "batch_distincts": f"""WITH {_EVENTS}
SELECT count(DISTINCT author_name) FILTER (author_name <> '') AS unique_authors,
  (SELECT count(DISTINCT tag) FROM (SELECT unnest(tags) AS tag FROM q_events)) AS unique_tags FROM q_events""",
    "storage_metrics": f"""WITH {_METRICS}
SELECT questions_attempted, questions_stored, authors_new, authors_updated,
  authors_new + authors_updated AS authors_total, 2.5::DOUBLE AS storage_duration,
  round(questions_stored / 2.5::DOUBLE, 6) AS storage_rate,
  round(CAST(questions_stored AS DOUBLE) / questions_attempted * 100, 6) AS efficiency,
  questions_attempted - questions_stored AS questions_ignored FROM metrics WHERE mode = 'append-only'""",
    "phase_share": """SELECT event_type AS phase, round(sum(value), 6) AS seconds,
  round(sum(value) / (SELECT sum(value) FROM events) * 100, 6) AS share FROM events GROUP BY event_type""",
    # authors
    "top_authors": f"WITH {_STORE} SELECT * FROM everyone ORDER BY question_count DESC, author_name LIMIT 10",
    "reputation_stats": f"WITH {_STORE} SELECT {_summary('reputation', 'mean', 'median', 'max', 'min')[0]} FROM everyone",
    "activity_stats": f"""WITH {_STORE}
SELECT round(avg(question_count), 6) AS mean_questions_per_author,
  round(median(question_count), 6) AS median_questions_per_author,
  (SELECT author_name FROM everyone ORDER BY question_count DESC, author_name LIMIT 1) AS most_active_author,
  max(question_count) AS most_active_count, count(*) AS total_authors FROM everyone""",
    "distinct_authors": f"""WITH {_EVENTS}
SELECT DISTINCT author_name FROM q_events WHERE trim(author_name) <> '' AND author_name <> 'Unknown'""",
    "authors_of_questions": f"""WITH {_STORE}
SELECT * FROM authors0 WHERE author_name IN (SELECT author_name FROM unseen)""",
    "author_activity_band": f"""WITH {_STORE}
SELECT author_name, question_count, CASE WHEN question_count >= 10 THEN '🔥 Très actif'
  WHEN question_count >= 5 THEN '⚡ Actif' ELSE '📝 Contributeur' END AS activity FROM everyone""",
    # retrieval
    "questions_page": f"""WITH {_EVENTS}
SELECT question_id, publication_date, array_to_string(tags, ',') AS tags FROM q_events
ORDER BY publication_date DESC NULLS LAST, question_id LIMIT 100 OFFSET 50""",
    "page_by_key": f"""WITH {_EVENTS}
SELECT question_id, publication_date, array_to_string(tags, ',') AS tags FROM q_events
ORDER BY publication_date DESC NULLS LAST, question_id LIMIT 100 OFFSET 150""",
    "page_by_number": f"""WITH {_EVENTS}
SELECT question_id, publication_date, array_to_string(tags, ',') AS tags FROM q_events
ORDER BY publication_date DESC NULLS LAST, question_id LIMIT 100 OFFSET 5000""",
    "days_between": f"""WITH {_EVENTS}
SELECT question_id, title, publication_date FROM q_events
WHERE publication_date BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 00:00:00'""",
    "questions_filtered": f"""WITH {_EVENTS}
SELECT question_id, title, vote_count, answer_count FROM q_events WHERE vote_count >= 10 AND answer_count IN (0, 3)""",
    "questions_by_ids": f"""WITH {_STORE}
SELECT question_id, title, publication_date FROM q_events WHERE question_id IN (SELECT question_id FROM incoming)""",
    "questions_any_tag": f"""WITH {_EVENTS}
SELECT question_id, array_to_string(tags, ',') AS tags, publication_date FROM q_events
WHERE list_has_any(tags, ['error', 'k7']) """,
    "questions_all_tags": f"""WITH {_EVENTS}
SELECT question_id, array_to_string(tags, ',') AS tags, publication_date FROM q_events
WHERE list_has_all(tags, ['error', 'k7']) """,
    "questions_date_range": f"""WITH {_ORDERS}
SELECT question_id, publication_date, view_count FROM q_orders
WHERE publication_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-01'
""",
    "question_ids": "SELECT event_id AS question_id FROM events",
    "first_last_question": f"""WITH {_EVENTS},
f AS (SELECT question_id, publication_date FROM q_events ORDER BY publication_date, question_id LIMIT 1),
l AS (SELECT question_id, publication_date FROM q_events ORDER BY publication_date DESC, question_id LIMIT 1)
SELECT f.question_id AS first_id, f.publication_date AS first_date, l.question_id AS last_id,
  l.publication_date AS last_date FROM f, l""",
    "valid_dates": "SELECT event_id, CAST(ts AS TIMESTAMP) AS publication_date FROM events WHERE event_type <> 'error'",
    "question_defaults": f"""WITH {_EVENTS}
SELECT question_id, CASE WHEN answer_count > 3 THEN title ELSE '' END AS title, '' AS summary,
  CASE WHEN answer_count > 2 THEN array_to_string(tags, ',') ELSE '' END AS tags,
  CASE WHEN answer_count > 1 THEN author_name ELSE 'Unknown' END AS author_name,
  CAST(0 AS BIGINT) AS author_reputation, CASE WHEN vote_count > 0 THEN vote_count ELSE 0 END AS vote_count FROM q_events""",
    "field_exists": f"""WITH {_EVENTS}
SELECT question_id AS event_id, vote_count + 50 AS k FROM q_events WHERE vote_count < 0""",
    "id_sets": f"""WITH {_STORE}
SELECT DISTINCT question_id, CASE WHEN question_id IN (SELECT question_id FROM existing)
  THEN 'existing' ELSE 'new' END AS state FROM incoming""",
    "batch_concat": f"""WITH {_STORE}
SELECT question_id, count(*) AS rows, CAST(sum(vote_count) AS BIGINT) AS votes FROM (
  SELECT question_id, vote_count FROM existing UNION ALL SELECT question_id, vote_count FROM incoming) GROUP BY question_id""",
    "scope_status": f"""WITH {_STORE}
SELECT 'new-only' AS scope, CASE WHEN count(*) > 0 THEN 'analysed' ELSE 'skipped' END AS status FROM unseen""",
    "scoped_tag_frequency": f"""WITH {_STORE}
SELECT tag, count(*) AS count FROM (
  SELECT unnest(tags) AS tag FROM q_events WHERE question_id IN (SELECT question_id FROM unseen))
GROUP BY tag ORDER BY count DESC, tag LIMIT 20""",
    # text
    "cleaned_text": f"""WITH {_corpus('combined')}
SELECT doc AS question_id, md5({_clean('text')}) AS clean_md5, md5(array_to_string({_tokens('text')}, ' ')) AS tokens_md5
FROM corpus""",
    "lemmatised_tokens": f"""WITH {_corpus('combined')}
SELECT doc AS question_id, md5(array_to_string(tokens, ' ')) AS lemmas_md5
FROM (SELECT doc, {_lemmas(_tokens('text'))} AS tokens FROM corpus) WHERE len(tokens) > 0""",
    "part_lemmas": f"""WITH texts AS (SELECT p_partkey AS part,
  lower(p_name) || ' boxes studies children classes buses status women analyses wolves' AS text FROM part)
SELECT part, array_to_string({_lemmas(_tokens('text'))}, ',') AS tokens FROM texts""",
    "keywords_title": _keywords(["title"], {"title": 20}),
    "keywords_summary": _keywords(["summary"], {"summary": 20}),
    "keywords_combined": _keywords(["combined"], {"combined": 30}),
    "report_keywords": _keywords(["title", "summary", "combined"], {"title": 15, "summary": 15, "combined": 20}),
    "text_polarity": _POLARITY + """SELECT source, doc, round(polarity, 6) AS polarity,
  CASE WHEN polarity > 0.1 THEN 'positive' WHEN polarity < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM (SELECT source, doc, coalesce(polarity, 0.0) AS polarity FROM texts LEFT JOIN polar USING (source, doc))""",
    "sentiment_summary": _POLARITY + "SELECT * FROM summary",
    "sentiment_share": _POLARITY + ",\nshares AS (" + " UNION ALL ".join(
        f"SELECT source, '{c}' AS sentiment, {c} AS texts, round(CAST({c} AS DOUBLE) / total * 100, 6) AS share "
        "FROM summary WHERE total > 0" for c in ("positive", "neutral", "negative")) + ") SELECT * FROM shares",
    "summary_completeness": _quality(*_DEFAULT_QUALITY, "summary_completeness"),
    "technical_richness": _quality(
        *_FREQUENT_QUALITY, "technical_word_ratio, avg_words_per_question, technical_term_count"),
    "technical_depth": _quality(*_FREQUENT_QUALITY, "technical_depth"),
    "question_clarity": _quality(*_FREQUENT_QUALITY, "clear_questions_ratio, questions_with_context"),
    "content_quality": _quality(*_DEFAULT_QUALITY, "*"),
    "quality_bands": _quality(*_FREQUENT_QUALITY, "*", f"({_BANDS})"),
    "length_stats": rf"""WITH {_DOCS}
SELECT round(coalesce(avg(length(title)) FILTER (title <> ''), 0.0), 6) AS average_title_length,
  round(coalesce(avg(length(summary)) FILTER (summary <> ''), 0.0), 6) AS average_summary_length,
  round(coalesce(avg(len(list_filter(regexp_split_to_array(title, '\s+'), lambda w: w <> ''))) FILTER (title <> ''), 0.0), 6)
    AS title_word_count,
  round(coalesce(avg(len(list_filter(regexp_split_to_array(summary, '\s+'), lambda w: w <> ''))) FILTER (summary <> ''), 0.0), 6)
    AS summary_word_count FROM q_docs""",
    # writes
    "store_upsert": _UPSERTED,
    "store_append_only": _APPENDED,
    "store_update_only": f"""WITH {_STORE}
SELECT {_QUESTION_OUT} FROM existing WHERE question_id NOT IN (SELECT question_id FROM fresh)
UNION ALL SELECT {_QUESTION_OUT} FROM fresh WHERE question_id IN (SELECT question_id FROM existing)""",
    "upsert_questions": _UPSERTED,
    "update_only_questions": f"""WITH {_STORE}
SELECT {_QUESTION_OUT} FROM existing WHERE question_id NOT IN (SELECT question_id FROM fresh)
UNION ALL SELECT {_QUESTION_OUT} FROM fresh WHERE question_id IN (SELECT question_id FROM existing)""",
    "append_only_questions": _APPENDED,
    "latest_versions": f"WITH {_STORE} SELECT question_id, max(vote_count) AS vote_count, any_value(array_to_string(tags, ',')) AS tags FROM versions GROUP BY question_id",
    "upsert_authors": _authors("incoming", "FULL OUTER"),
    "update_only_authors": _authors("incoming", "LEFT"),
    "write_metrics": f"WITH {_METRICS} SELECT * FROM metrics",
    "touched_ids": f"""WITH {_STORE}
SELECT DISTINCT 'upsert' AS mode, question_id FROM incoming UNION ALL SELECT DISTINCT 'update', question_id FROM known
UNION ALL SELECT DISTINCT 'append-only', question_id FROM unseen""",
    "refresh_batches": f"WITH {_refresh(100)} SELECT * FROM refreshed",
    "refresh_rollup": f"WITH {_refresh(100)} SELECT * FROM rollup",
    "refresh_dry_run": f"WITH {_refresh(250, dry_run=True)} SELECT * FROM rollup",
    "refresh_flags": f"""WITH {_refresh(100)}
SELECT *, 29.2::DOUBLE AS duration, round(processed / 29.2::DOUBLE, 6) AS questions_per_second,
  round(CAST(errors AS DOUBLE) / processed * 100, 6) AS error_rate,
  round(CAST(skipped AS DOUBLE) / processed * 100, 6) AS skipped_rate,
  round(29.2::DOUBLE / processed * 1000, 6) AS ms_per_question,
  CASE WHEN errors * 100.0 / processed > 10 THEN 'high' WHEN errors > 0 THEN 'acceptable' ELSE 'none' END AS error_level,
  CASE WHEN processed / 29.2 < 1 THEN 'slow' WHEN processed / 29.2 > 10 THEN 'excellent' ELSE 'normal' END AS speed,
  skipped > updated AS many_skipped FROM rollup""",
    "bulk_lookup": f"""WITH {_refresh(100)}
SELECT question_id, CAST(batch_no AS BIGINT) AS batch_no, vote_count FROM batches JOIN fresh USING (question_id)""",
    # ingest
    "payload_to_questions": f"""WITH {_EVENTS}, shown AS (
  SELECT * REPLACE (date_trunc('second', publication_date) AS publication_date,
    {_PAYLOAD_BODY} AS summary) FROM q_events)
SELECT {_PLAIN_OUT} FROM shown""",
    "payload_newest": f"""WITH {_EVENTS}
SELECT question_id, date_trunc('second', publication_date) AS publication_date, vote_count FROM q_events
ORDER BY 2 DESC, question_id LIMIT 500""",
    "listing_extract": f"""WITH {_EVENTS}, shown AS (
  SELECT * REPLACE (date_trunc('second', publication_date) AS publication_date,
    'https://example.com' || url AS url, 'https://example.com' || author_profile_url AS author_profile_url,
    CASE WHEN author_reputation >= 1000 THEN CAST(trunc(CAST(author_reputation / 1000.0::DOUBLE AS DOUBLE) * 1000) AS BIGINT)
      ELSE author_reputation END AS author_reputation) FROM q_events)
SELECT {_PLAIN_OUT} FROM shown""",
    "page_links": r"""SELECT page_id, CAST(i - 1 AS BIGINT) AS position, href[i] AS href, label[i] AS label FROM (
  SELECT page_id, href, label, unnest(range(1, len(href) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS href,
      regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS label FROM pages))""",
    "page_titles": "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages",
    "page_body_summary": f"""SELECT page_id, {_CUT.format('body')} AS summary, length(body) AS full_length
FROM (SELECT page_id, {_BODY.format('html')} AS body FROM pages)""",
    # profile
    "numeric_profile": f"WITH {_EVENTS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"round(avg({c}), 6) AS avg FROM q_events" for c in ("view_count", "answer_count", "question_id")),
    "date_profile": f"WITH {_STORE} " + " UNION ALL ".join(
        f"SELECT '{c}' AS field, strftime(min({c}), '%Y-%m-%d %H:%M') AS oldest, strftime(max({c}), '%Y-%m-%d %H:%M') AS newest "
        "FROM (SELECT *, TIMESTAMP '2024-01-21' AS stored_at FROM q_events)" for c in ("publication_date", "stored_at")),
    "size_profile": """SELECT count(*) AS rows, round(CAST(sum(bytes) AS DOUBLE) / (1024 * 1024), 6) AS total_mb,
  round(avg(bytes), 6) AS avg_bytes FROM (SELECT strlen('{' || concat_ws(',', '"doc_id":' || doc_id,
  '"quality":' || quality, '"toxic":' || toxic) || '}') AS bytes FROM labels)""",
    "schema_profile": f"WITH {_JSON_FIELDS} SELECT field_path, type, count(*) AS count FROM fields GROUP BY ALL",
    "schema_summary": f"""WITH {_JSON_FIELDS}
SELECT field_path, CASE WHEN count(DISTINCT type) = 1 THEN min(type)
  ELSE 'Mixte (' || string_agg(DISTINCT type, ', ' ORDER BY type) || ')' END AS type, count(*) AS count
FROM fields GROUP BY field_path""",
    "random_sample": "SELECT least(100, count(*)) AS rows, least(100, count(*)) AS ids FROM events",
    "table_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES),
    "duplicate_keys": f"WITH {_STORE} SELECT question_id, count(*) AS count FROM versions GROUP BY question_id HAVING count(*) > 1",
    # logs
    "log_outcomes": f"WITH {_OUTCOMES} SELECT * FROM outcomes",
    "log_rollup": _log_rollup("passed + failed + error + skipped"),
    "log_rollup_without_errors": _log_rollup("passed + failed + skipped"),
    "slowest_tests": f"""WITH {_OUTCOMES}
SELECT * FROM outcomes WHERE outcome IN ('passed', 'failed', 'error') ORDER BY duration DESC, name LIMIT 5""",
    # export
    "analysis_rows": f"""WITH {_ORDERS},
top AS (SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM q_orders) GROUP BY tag ORDER BY n DESC, tag LIMIT 20)
SELECT 'comprehensive_trend_analysis' AS analysis_type, TIMESTAMP '2001-08-01' AS analysis_date, 'top_tags' AS table,
  '{{"tag":"' || tag || '","count":' || n || '}}' AS result, (SELECT count(*) FROM q_orders) AS total_questions_analyzed FROM top""",
    "analysis_rows_nan": """SELECT 'shares' AS table, '{"event_type":"' || event_type || '","n":' || count(*)
  || CASE WHEN event_type = 'error' THEN '' ELSE ',"share":0.5' END || '}' AS result FROM events GROUP BY event_type""",
    "exported_rows": f"""WITH {_EVENTS}
SELECT tag, count(*) AS count FROM (SELECT unnest(tags) AS tag FROM q_events) GROUP BY tag""",
    # Listings are empty; tables of one row (or one per counter) keep it: counts and numbers are 0, names and dates are left out.
    "empty_analysis": """WITH none AS (SELECT * FROM events WHERE event_id < 0)
SELECT name AS table, (SELECT count(*) FROM none) AS rows, '' AS result FROM (SELECT unnest([
  'trending_tags', 'top_tags', 'hourly_patterns', 'weekday_patterns', 'monthly_patterns', 'keywords', 'sentiment', 'top_authors',
  'most_common_tags']) AS name)
UNION ALL SELECT col0, CAST(col1 AS BIGINT), col2 FROM (VALUES
  ('status', 1, '{"scope":"all","status":"skipped"}'), ('date_range', 1, '{}'),
  ('activity_peaks', 1, '{"total_questions_analyzed":0}'),
  ('content_quality', 1, '{"summary_completeness":0.0,"technical_word_ratio":0.0,"avg_words_per_question":0.0,"technical_term_count":0,"technical_depth":0.0,"clear_questions_ratio":0.0,"questions_with_context":0}'),
  ('length_stats', 1, '{"average_title_length":0.0,"average_summary_length":0.0,"title_word_count":0.0,"summary_word_count":0.0}'),
  ('reputation_stats', 1, '{"mean":0.0,"median":0.0,"max":0.0,"min":0.0}'),
  ('activity_stats', 1, '{"mean_questions_per_author":0.0,"median_questions_per_author":0.0,"most_active_count":0,"total_authors":0}'),
  ('tag_summary', 1, '{"total_unique_tags":0,"total_tags":0,"total_questions":0,"average_tags_per_question":0.0}'),
  ('counter_stats', 3, '{"metric":"answer_count","mean":0.0,"median":0.0,"min":0.0,"max":0.0,"std":0.0,"zero_rate":0.0};{"metric":"view_count","mean":0.0,"median":0.0,"min":0.0,"max":0.0,"std":0.0,"zero_rate":0.0};{"metric":"vote_count","mean":0.0,"median":0.0,"min":0.0,"max":0.0,"std":0.0,"zero_rate":0.0}'))""",
    "newest_logs": """SELECT kind, path FROM (SELECT kind, path, row_number() OVER (PARTITION BY kind ORDER BY ts DESC, path DESC) AS rn
  FROM (SELECT ts, ['run', 'errors', 'summary', 'other'][user_id % 4 + 1] AS kind,
    '/logs/test_' || ['run', 'errors', 'summary', 'other'][user_id % 4 + 1] || '_' || event_id || '.log' AS path FROM events)
  WHERE kind <> 'other') WHERE rn = 1""",
    "sample_members": "SELECT name AS check, (SELECT least(100, count(*)) FROM events) AS rows "
    "FROM (SELECT unnest(['members', 'drawn again']) AS name)",
    "payload_unreadable": """WITH pages AS (SELECT DISTINCT event_id // 100 AS page FROM events)
SELECT count(*) AS pages, count(*) FILTER (page % 10 = 0) AS unreadable FROM pages""",
    "listing_unreadable": "SELECT DISTINCT event_id // 50 AS page_id FROM events WHERE (event_id // 50) % 10 = 0",
    "schema_profile_unreadable": "SELECT '' AS field_path, 'unreadable' AS type, count(*) AS count FROM events WHERE event_id % 10 = 0",
    "refresh_questions": f"""WITH {_STORE}
SELECT {_QUESTION_OUT} FROM existing WHERE question_id NOT IN (SELECT question_id FROM fresh)
UNION ALL SELECT {_QUESTION_OUT} FROM fresh WHERE question_id IN (SELECT question_id FROM existing)""",
    "refresh_authors": _authors("incoming", "LEFT"),
    "refresh_dry_questions": f"WITH {_STORE} SELECT {_QUESTION_OUT} FROM existing",
    "export_newest": f"""WITH {_EVENTS}
SELECT question_id, title, publication_date, vote_count FROM q_events""",
    "export_authors": f"WITH {_STORE} SELECT * FROM everyone",
    "report_trending_tags": f"""WITH {_ORDER_TRENDS}
SELECT row_number() OVER (ORDER BY growth_rate DESC, last_month DESC, tag) AS rank, tag, growth_rate, total_questions,
  last_week, last_month FROM trends ORDER BY rank LIMIT 15""",
    "report_common_tags": f"""WITH {_ORDERS},
counts AS (SELECT tag, count(*) AS count FROM (SELECT unnest(tags) AS tag FROM q_orders) GROUP BY tag)
SELECT row_number() OVER (ORDER BY count DESC, tag) AS rank, tag, count FROM counts ORDER BY rank LIMIT 15""",
    "report_top_authors": f"""WITH {_STORE}
SELECT row_number() OVER (ORDER BY question_count DESC, author_name) AS rank, author_name, reputation, question_count,
  CASE WHEN question_count >= 10 THEN '🔥 Très actif' WHEN question_count >= 5 THEN '⚡ Actif'
    ELSE '📝 Contributeur' END AS activity FROM everyone ORDER BY rank LIMIT 10""",
    "report_counters": f"WITH {_EVENTS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS metric, {_summary(c, 'mean', 'median', 'min', 'max', 'std')[0]}, "
        f"{_summary(c)[1]} AS zero_rate FROM q_events" for c in ("vote_count", "view_count", "answer_count")),
    # streams
    "stream_append": _APPENDED,
    "stream_upsert": _UPSERTED,
    "stream_upsert_authors": _authors("incoming", "FULL OUTER"),
    "stream_tag_windows": f"""WITH {_EVENTS}
SELECT date_trunc('day', publication_date)::TIMESTAMP AS window_start, tag, count(*) AS count
FROM (SELECT publication_date, unnest(tags) AS tag FROM q_events) GROUP BY ALL""",
    "stream_new_only": f"""WITH {_STORE}
SELECT tag, count(*) AS count FROM (SELECT unnest(tags) AS tag FROM fresh
  WHERE question_id NOT IN (SELECT question_id FROM existing)) GROUP BY tag""",
}
