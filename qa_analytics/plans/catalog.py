"""Named queries over the test tables, one or more per operator."""

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.labels import activity_band
from ..functions.text import clean_text, clean_tokens, combined_text
from ..operators import (
    filters, keywords, logs as log_ops, profile, quality, refresh, report, sentiment, stats, tags, temporal, writes,
)
from ..session import staging_path
from ..sources import buckets, listings, logs as log_files, payloads, periods, tables
from ..streaming import ingest, windows
from . import adapters as a, analysis

QUERIES = {}

ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()


def plain(df: DataFrame) -> DataFrame:
    """Comparable values: six decimals, wall-clock UTC times, arrays as text."""
    cols = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(col, 6) + 0.0
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        elif isinstance(field.dataType, T.IntegerType):
            col = col.cast("long")
        cols.append(col.alias(field.name))
    return df.select(*cols)


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


# ---- tags ------------------------------------------------------------------

@query
def tag_statistics(spark, d):
    return tags.tag_statistics(a.q_orders(spark, d))


@query
def tag_frequency(spark, d):
    return tags.tag_frequency(a.q_orders(spark, d))


@query
def tag_summary(spark, d):
    return tags.tag_summary(a.q_orders(spark, d))


@query
def tag_trends(spark, d):
    return tags.tag_trends(a.q_orders(spark, d), a.ORDERS_AS_OF)


@query
def tag_trends_events(spark, d):
    return tags.tag_trends(a.q_events(spark, d), a.EVENTS_AS_OF)


@query
def trending_tags(spark, d):
    return tags.trending_tags(tag_trends(spark, d))


@query
def top_tags(spark, d):
    return tags.top_tags(tag_trends(spark, d))


@query
def declining_tags(spark, d):
    return tags.declining_tags(tag_trends(spark, d))


@query
def batch_members(spark, d):
    return filters.batch_members(a.q_events(spark, d))


# ---- temporal --------------------------------------------------------------

@query
def hourly_patterns(spark, d):
    return temporal.activity_patterns(a.q_events(spark, d), "hour")


@query
def weekday_patterns(spark, d):
    return temporal.activity_patterns(a.q_events(spark, d), "day_of_week")


@query
def monthly_patterns(spark, d):
    return temporal.activity_patterns(a.q_orders(spark, d), "month")


@query
def activity_peaks(spark, d):
    return temporal.activity_peaks(a.q_events(spark, d))


@query
def date_range(spark, d):
    return temporal.date_range(a.q_events(spark, d))


# ---- general ---------------------------------------------------------------

@query
def vote_stats(spark, d):
    return stats.vote_stats(a.q_events(spark, d))


@query
def view_stats(spark, d):
    return stats.view_stats(a.q_orders(spark, d))


@query
def answer_stats(spark, d):
    return stats.answer_stats(a.q_events(spark, d))


@query
def store_stats(spark, d):
    return stats.store_stats(a.q_events(spark, d), a.all_authors(spark, d))


@query
def batch_distincts(spark, d):
    return stats.batch_distincts(a.q_events(spark, d))


@query
def storage_metrics(spark, d):
    counts = writes.write_metrics(a.existing(spark, d), a.authors0(spark, d), a.incoming(spark, d), "append-only")
    return stats.run_metrics(counts, 2.5)


@query
def phase_share(spark, d):
    events = a.table(spark, d, "events")
    return stats.phase_share(events.select(F.col("event_type").alias("phase"), F.col("value").alias("seconds")))


# ---- authors ---------------------------------------------------------------

@query
def top_authors(spark, d):
    return filters.top_authors(a.all_authors(spark, d))


@query
def reputation_stats(spark, d):
    return stats.reputation_stats(a.all_authors(spark, d))


@query
def activity_stats(spark, d):
    return stats.activity_stats(a.all_authors(spark, d))


@query
def distinct_authors(spark, d):
    return filters.distinct_authors(a.q_events(spark, d))


@query
def authors_of_questions(spark, d):
    touched = writes.touched_ids(a.existing(spark, d), a.incoming(spark, d), "append-only")
    return filters.authors_of_questions(a.incoming(spark, d), a.authors0(spark, d), touched)


@query
def author_activity_band(spark, d):
    return a.all_authors(spark, d).select(
        "author_name", "question_count", activity_band(F.col("question_count")).alias("activity"))


# ---- retrieval -------------------------------------------------------------

@query
def questions_page(spark, d):
    return filters.newest_first(a.q_events(spark, d), limit=100, skip=50).select("question_id", "publication_date", "tags")


def _by_day(spark, d):
    """The questions laid out by day of publication."""
    path = staging_path(spark, "days")
    periods.write_periods(filters.with_audit(a.q_events(spark, d), a.WRITTEN_AT), path, "day")
    return path


@query
def page_by_key(spark, d):
    path = _by_day(spark, d)
    before = periods.last_key(periods.page_after(spark, path, 150, unit="day"))
    return periods.page_after(spark, path, 100, before, "day").select("question_id", "publication_date", "tags")


@query
def page_by_number(spark, d):
    found = periods.page_at(spark, _by_day(spark, d), 100, 5000, "day")
    return found.select("question_id", "publication_date", "tags")


@query
def days_between(spark, d):
    found = periods.published_between(spark, _by_day(spark, d), "2024-01-10 06:00:00", "2024-01-12", "day")
    return found.select("question_id", "title", "publication_date")


@query
def questions_filtered(spark, d):
    found = filters.matching(a.q_events(spark, d), "vote_count >= 10 AND answer_count IN (0, 3)")
    return found.select("question_id", "title", "vote_count", "answer_count")


@query
def questions_by_ids(spark, d):
    return filters.by_ids(a.q_events(spark, d), a.incoming(spark, d)).select("question_id", "title", "publication_date")


@query
def questions_any_tag(spark, d):
    return filters.with_tags(a.q_events(spark, d), ["error", "k7"]).select("question_id", "tags", "publication_date")


@query
def questions_all_tags(spark, d):
    return filters.with_tags(a.q_events(spark, d), ["error", "k7"], match="all").select("question_id", "tags", "publication_date")


@query
def questions_date_range(spark, d):
    found = filters.in_date_range(a.q_orders(spark, d), "1998-01-01", "1998-03-01")
    return found.select("question_id", "publication_date", "view_count")


@query
def question_ids(spark, d):
    return filters.question_ids(a.q_events(spark, d))


@query
def first_last_question(spark, d):
    return filters.edge_questions(a.q_events(spark, d))


@query
def valid_dates(spark, d):
    events = a.table(spark, d, "events")
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("day "), "event_id")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    dated = filters.valid_dates(events.select("event_id", text.alias("date_text")), "date_text")
    return dated.select("event_id", "publication_date")


@query
def question_defaults(spark, d):
    gaps = a.q_events(spark, d).select(
        "question_id", "publication_date",
        F.when(F.col("vote_count") > 0, F.col("vote_count")).alias("vote_count"),
        F.when(F.col("answer_count") > 2, F.col("tags")).alias("tags"),
        F.when(F.col("answer_count") > 1, F.col("author_name")).alias("author_name"),
        F.when(F.col("answer_count") > 3, F.col("title")).alias("title"))
    return filters.with_defaults(gaps).select(
        "question_id", "title", "summary", "tags", "author_name", "author_reputation", "vote_count")


@query
def field_exists(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    rows = a.table(spark, d, "events").select("event_id", F.when(k < 50, k).alias("k"))
    return filters.field_exists(rows, "k")


@query
def id_sets(spark, d):
    return filters.id_sets(a.existing(spark, d), a.incoming(spark, d))


@query
def batch_concat(spark, d):
    both = filters.concat_batches([
        a.existing(spark, d).select("question_id", "vote_count"), a.incoming(spark, d).select("question_id", "vote_count")])
    return both.groupBy("question_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("vote_count").alias("votes"))


@query
def scope_status(spark, d):
    touched = writes.touched_ids(a.existing(spark, d), a.incoming(spark, d), "append-only")
    return filters.analysis_scope(a.q_events(spark, d), touched)[1]


@query
def scoped_tag_frequency(spark, d):
    touched = writes.touched_ids(a.existing(spark, d), a.incoming(spark, d), "append-only")
    return tags.tag_frequency(filters.analysis_scope(a.q_events(spark, d), touched)[0])


# ---- text ------------------------------------------------------------------

@query
def cleaned_text(spark, d):
    text = a.q_docs(spark, d).select("question_id", combined_text(F.col("title"), F.col("summary")).alias("text"))
    return text.select("question_id", F.md5(clean_text(F.col("text"))).alias("clean_md5"),
                       F.md5(F.array_join(clean_tokens(F.col("text")), " ")).alias("tokens_md5"))


@query
def lemmatised_tokens(spark, d):
    corpus = keywords.question_texts(a.q_docs(spark, d), ("combined",))
    return keywords.tokenised(corpus).select(
        F.col("doc").alias("question_id"), F.md5(F.array_join("tokens", " ")).alias("lemmas_md5"))


@query
def part_lemmas(spark, d):
    """Names of parts with words that end in plurals of every kind."""
    text = F.concat_ws(" ", F.lower("p_name"), F.lit("boxes studies children classes buses status women analyses wolves"))
    words = a.table(spark, d, "part").select(F.col("p_partkey").alias("doc"), F.lit("part").alias("source"), text.alias("text"))
    return keywords.tokenised(words).select(F.col("doc").alias("part"), "tokens")


def _keywords(spark, d, source):
    corpus = keywords.question_texts(a.q_docs(spark, d), (source,))
    return keywords.top_keywords(keywords.keyword_scores(corpus, {source: keywords.MAX_FEATURES[source]}))


@query
def keywords_title(spark, d):
    return _keywords(spark, d, "title")


@query
def keywords_summary(spark, d):
    return _keywords(spark, d, "summary")


@query
def keywords_combined(spark, d):
    return _keywords(spark, d, "combined")


@query
def report_keywords(spark, d):
    return report.keyword_table(keywords.question_scores(a.q_docs(spark, d)))


def _sentiment(spark, d):
    return sentiment.sentiment_summary(keywords.question_texts(a.q_docs(spark, d)), sentiment.default_lexicon(spark))


@query
def text_polarity(spark, d):
    corpus = keywords.question_texts(a.q_docs(spark, d))
    return sentiment.classify(sentiment.text_polarity(corpus, sentiment.default_lexicon(spark)))


@query
def sentiment_summary(spark, d):
    return _sentiment(spark, d)


@query
def sentiment_share(spark, d):
    return sentiment.sentiment_share(_sentiment(spark, d))


def _frequent_words_quality(spark, d):
    """The same operator with terms that are frequent in the test texts."""
    return quality.content_quality(
        a.q_docs(spark, d), technical_terms=["the", "and", "with", "le", "der"], advanced_terms=["ation", "onst", "er th"],
        question_signs=["what", "wh", "?"], code_signs=["ing", "ou"])


@query
def summary_completeness(spark, d):
    return quality.content_quality(a.q_docs(spark, d)).select("summary_completeness")


@query
def technical_richness(spark, d):
    return _frequent_words_quality(spark, d).select(
        "technical_word_ratio", "avg_words_per_question", "technical_term_count")


@query
def technical_depth(spark, d):
    return _frequent_words_quality(spark, d).select("technical_depth")


@query
def question_clarity(spark, d):
    return _frequent_words_quality(spark, d).select("clear_questions_ratio", "questions_with_context")


@query
def content_quality(spark, d):
    return quality.content_quality(a.q_docs(spark, d))


@query
def quality_bands(spark, d):
    return quality.quality_bands(_frequent_words_quality(spark, d))


@query
def length_stats(spark, d):
    return quality.length_stats(a.q_docs(spark, d))


# ---- writes ----------------------------------------------------------------

@query
def upsert_questions(spark, d):
    return writes.upsert_questions(a.existing(spark, d), a.incoming(spark, d), a.WRITTEN_AT)


@query
def update_only_questions(spark, d):
    return writes.update_only_questions(a.existing(spark, d), a.incoming(spark, d), a.WRITTEN_AT)


@query
def append_only_questions(spark, d):
    return writes.append_only_questions(a.existing(spark, d), a.incoming(spark, d), a.WRITTEN_AT)


def _written_store(spark, d, write):
    """The stored table after a write into its buckets."""
    path = staging_path(spark, "store")
    buckets.create_store(a.existing(spark, d), path)
    write(spark, path, a.incoming(spark, d), a.WRITTEN_AT)
    return buckets.stored_questions(spark, path)


@query
def store_upsert(spark, d):
    return _written_store(spark, d, buckets.upsert_into)


@query
def store_update_only(spark, d):
    return _written_store(spark, d, buckets.update_in)


@query
def store_append_only(spark, d):
    return _written_store(spark, d, buckets.append_to)


@query
def latest_versions(spark, d):
    return writes.latest_per_key(a.all_versions(spark, d)).select("question_id", "vote_count", "tags")


@query
def upsert_authors(spark, d):
    return writes.upsert_authors(a.authors0(spark, d), a.incoming(spark, d), a.WRITTEN_AT)


@query
def update_only_authors(spark, d):
    return writes.update_only_authors(a.authors0(spark, d), a.incoming(spark, d), a.WRITTEN_AT)


@query
def write_metrics(spark, d):
    old, people, new = a.existing(spark, d), a.authors0(spark, d), a.incoming(spark, d)
    return filters.concat_batches([
        writes.write_metrics(old, people, new, mode).withColumn("mode", F.lit(mode)) for mode in writes.MODES])


@query
def touched_ids(spark, d):
    old, new = a.existing(spark, d), a.incoming(spark, d)
    return filters.concat_batches([
        writes.touched_ids(old, new, mode).withColumn("mode", F.lit(mode)) for mode in writes.MODES])


def _refresh(spark, d, **options):
    return refresh.refresh_batches(a.existing(spark, d), a.authors0(spark, d), a.incoming(spark, d), **options)


@query
def refresh_batches(spark, d):
    return _refresh(spark, d)


@query
def refresh_rollup(spark, d):
    return refresh.refresh_rollup(_refresh(spark, d))


@query
def refresh_dry_run(spark, d):
    return refresh.refresh_rollup(_refresh(spark, d, batch_size=250, dry_run=True))


@query
def refresh_flags(spark, d):
    return refresh.refresh_report(refresh.refresh_rollup(_refresh(spark, d), duration=29.2))


def _refreshed(spark, d, **options):
    return refresh.refreshed(a.existing(spark, d), a.authors0(spark, d), a.incoming(spark, d), a.WRITTEN_AT, **options)


@query
def refresh_questions(spark, d):
    return _refreshed(spark, d)["questions"]


@query
def refresh_authors(spark, d):
    return _refreshed(spark, d)["authors"]


@query
def refresh_dry_questions(spark, d):
    return _refreshed(spark, d, dry_run=True)["questions"]


@query
def bulk_lookup(spark, d):
    found = refresh.bulk_lookup(a.existing(spark, d), writes.latest_per_key(a.incoming(spark, d)))
    return found.select("question_id", "batch_no", "vote_count")


# ---- ingest ----------------------------------------------------------------

@query
def payload_to_questions(spark, d):
    return payloads.payload_questions(payloads.parse_payloads(a.payload_pages(spark, d), "payload"))


@query
def payload_unreadable(spark, d):
    """Every tenth page is cut off in the middle."""
    pages = a.payload_pages(spark, d)
    cut = F.when(F.col("page") % 10 == 0, F.expr("left(payload, 50)")).otherwise(F.col("payload"))
    return payloads.unreadable_payloads(pages.select(cut.alias("payload")), "payload")


@query
def payload_newest(spark, d):
    capped = payloads.payload_questions(payloads.parse_payloads(a.payload_pages(spark, d), "payload"), 500)
    return capped.select("question_id", "publication_date", "vote_count")


@query
def listing_extract(spark, d):
    return listings.listing_questions(a.listing_pages(spark, d), "https://example.com", a.EVENTS_AS_OF)


@query
def listing_unreadable(spark, d):
    """Every tenth page holds a broken declaration that no parser reads."""
    pages = a.listing_pages(spark, d)
    broken = F.when(F.col("page_id") % 10 == 0, F.concat(F.lit("<![ bad"), "html")).otherwise(F.col("html"))
    return listings.unreadable_pages(pages.select("page_id", broken.alias("html")))


@query
def page_links(spark, d):
    return listings.page_links(a.table(spark, d, "pages"))


@query
def page_titles(spark, d):
    return listings.page_titles(a.table(spark, d, "pages"))


@query
def page_body_summary(spark, d):
    return a.table(spark, d, "pages").select(
        "page_id", payloads.body_summary(F.col("html"), 500).alias("summary"),
        F.length(payloads.body_summary(F.col("html"))).alias("full_length"))


# ---- profile ---------------------------------------------------------------

@query
def numeric_profile(spark, d):
    return profile.numeric_profile(a.q_events(spark, d))


@query
def date_profile(spark, d):
    return profile.date_profile(a.all_stored(spark, d), ["created_at", "publication_date", "stored_at"])


@query
def size_profile(spark, d):
    return profile.size_profile(a.table(spark, d, "labels"))


def _documents_as_json(spark, d):
    """Events as JSON documents with nested, mixed and empty fields."""
    k = F.get_json_object("props", "$.k").cast("long")
    mixed = F.when(k < 50, k.cast("string")).otherwise(F.concat(F.lit('"'), k, F.lit('"')))
    listed = F.when(k < 30, "[]").when(k < 60, F.concat(F.lit("["), k, F.lit("]"))).otherwise('["a", 1]')
    events = a.dealt(a.table(spark, d, "events").drop("ts", "value"), "event_id")
    return events.select(F.concat(
        F.lit('{"_id": 1, "event_id": '), "event_id", F.lit(', "who": {"user": '), "user_id",
        F.lit(', "props": '), "props", F.lit('}, "mixed": '), mixed, F.lit(', "list": '), listed,
        F.lit(', "type": "'), "event_type", F.lit('", "none": null, "flag": true, "share": 0.5, "empty": {}}'),
    ).alias("doc"))


@query
def schema_profile(spark, d):
    return profile.schema_profile(_documents_as_json(spark, d), "doc").select("field_path", "type", "count")


@query
def schema_profile_unreadable(spark, d):
    """Every tenth document is cut off."""
    docs = _documents_as_json(spark, d).withColumn("n", F.get_json_object("doc", "$.event_id").cast("long"))
    cut = F.when(F.col("n") % 10 == 0, F.expr("left(doc, 20)")).otherwise(F.col("doc"))
    found = profile.schema_profile(docs.select(cut.alias("doc")), "doc")
    return found.where("type = 'unreadable'").select("field_path", "type", "count")


@query
def schema_summary(spark, d):
    return profile.schema_summary(profile.schema_profile(_documents_as_json(spark, d), "doc")).select(
        "field_path", "type", "count")


@query
def random_sample(spark, d):
    sample = profile.random_sample(a.q_events(spark, d).select("question_id"), 100, seed=7)
    return sample.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("question_id").alias("ids"))


@query
def sample_members(spark, d):
    """Sampled ids that are in the table, and those that the same seed draws again."""
    ids = a.q_events(spark, d).select("question_id")
    first, again = (profile.random_sample(ids, 100, seed=11) for _ in range(2))
    members = filters.by_ids(ids, first).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("members").alias("check"), "rows")
    same = filters.by_ids(first, again).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("drawn again").alias("check"), "rows")
    return members.unionByName(same)


@query
def table_inventory(spark, d):
    return profile.table_inventory({name: a.table(spark, d, name) for name in ALL_TABLES})


@query
def duplicate_keys(spark, d):
    return profile.duplicate_keys(a.all_versions(spark, d), "question_id")


# ---- logs ------------------------------------------------------------------

@query
def log_outcomes(spark, d):
    return log_files.log_outcomes(a.log_lines(spark, d))


def _log_rollup(spark, d, **options):
    lines = a.log_lines(spark, d)
    return log_ops.log_rollup(log_files.log_outcomes(lines), log_files.log_duration(lines), **options)


@query
def log_rollup(spark, d):
    return _log_rollup(spark, d)


@query
def log_rollup_without_errors(spark, d):
    return _log_rollup(spark, d, include_errors=False)


@query
def slowest_tests(spark, d):
    return log_ops.slowest_tests(log_files.log_outcomes(a.log_lines(spark, d)))


@query
def newest_logs(spark, d):
    """Every event as a log file of one of four kinds, three of which count."""
    kinds = F.array(*[F.lit(k) for k in ("run", "errors", "summary", "other")])
    name = F.concat(F.lit("/logs/test_"), F.get(kinds, (F.col("user_id") % 4).cast("int")), F.lit("_"), "event_id", F.lit(".log"))
    return log_files.newest_of_kind(a.table(spark, d, "events").select(name.alias("path"), F.col("ts").alias("modificationTime")))


# ---- export ----------------------------------------------------------------

@query
def analysis_rows(spark, d):
    rows = tables.analysis_rows(
        {"top_tags": tags.tag_frequency(a.q_orders(spark, d))}, "comprehensive_trend_analysis", a.ORDERS_AS_OF,
        a.q_orders(spark, d).agg(F.count(F.lit(1))).scalar(), 0.0)
    return rows.select("analysis_type", "analysis_date", "table", "result", "metadata.total_questions_analyzed")


@query
def analysis_rows_nan(spark, d):
    """A result table with values that are not numbers."""
    share = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(0.5)
    result = a.table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(
        "event_type", "n", share.alias("share"))
    return tables.result_rows(result, "shares")


@query
def exported_rows(spark, d):
    """Saved result tables, read back from their JSON files."""
    folder = staging_path(spark, "results")
    tables.save_results({"tags": tags.tag_frequency(a.q_events(spark, d), limit=None)}, folder, "run")
    return spark.read.schema("tag string, count long").json(f"{folder}/analysis_results_run/tags")


@query
def empty_analysis(spark, d):
    """Every result table of an analysis without questions, with its rows as JSON texts."""
    none = a.q_events(spark, d).where("question_id < 0")
    results = analysis.analyse(none, a.all_authors(spark, d).limit(0), a.EVENTS_AS_OF)
    texts = filters.concat_batches([tables.result_rows(t, n) for n, t in results.items()])
    every = spark.createDataFrame([(n,) for n in results], "table string")
    # One row per result table on the left.
    return every.join(texts, "table", "left").groupBy("table").agg(
        F.count("result").alias("rows"), F.array_join(F.sort_array(F.collect_list("result")), ";").alias("result"))


@query
def export_newest(spark, d):
    q, people = a.q_events(spark, d), a.all_authors(spark, d)
    return tables.export_tables(q, people, stats.store_stats(q, people), a.EVENTS_AS_OF)["questions"].select(
        "question_id", "title", "publication_date", "vote_count")


@query
def export_authors(spark, d):
    q, people = a.q_events(spark, d), a.all_authors(spark, d)
    return tables.export_tables(q, people, stats.store_stats(q, people), a.EVENTS_AS_OF)["authors"]


@query
def report_trending_tags(spark, d):
    return report.trending_table(tag_trends(spark, d))


@query
def report_common_tags(spark, d):
    return report.common_tags_table(tags.tag_frequency(a.q_orders(spark, d), limit=None))


@query
def report_top_authors(spark, d):
    return report.author_table(a.all_authors(spark, d))


@query
def report_counters(spark, d):
    return stats.counter_stats(a.q_events(spark, d))


# ---- streams ---------------------------------------------------------------

def _event_stream(spark, d):
    schema = a.table(spark, d, "events").schema
    return a.events_as_questions(ingest.question_stream(spark, d, schema, name_filter="events.parquet"))


def _seeded_store(spark, d, name):
    store = staging_path(spark, name)
    ingest.seed_store(spark, store, a.existing(spark, d), a.authors0(spark, d))
    return store


@query
def stream_append(spark, d):
    store = _seeded_store(spark, d, "stream-append")
    ingest.stream_append(a.as_incoming(_event_stream(spark, d)), store, f"{store}/progress", a.WRITTEN_AT)
    return ingest.current_questions(spark, store)


@query
def stream_upsert(spark, d):
    store = _seeded_store(spark, d, "stream-upsert")
    ingest.stream_upsert(a.as_incoming(_event_stream(spark, d)), store, f"{store}/progress", a.WRITTEN_AT)
    return ingest.current_questions(spark, store)


@query
def stream_upsert_authors(spark, d):
    store = _seeded_store(spark, d, "stream-authors")
    ingest.stream_upsert(a.as_incoming(_event_stream(spark, d)), store, f"{store}/progress", a.WRITTEN_AT)
    return ingest.current_authors(spark, store)


@query
def stream_tag_windows(spark, d):
    out = staging_path(spark, "stream-windows")
    windows.stream_tag_windows(_event_stream(spark, d), f"{out}/windows", f"{out}/progress")
    return windows.current_tag_windows(spark, f"{out}/windows")


@query
def stream_new_only(spark, d):
    store = _seeded_store(spark, d, "stream-new-only")
    ingest.stream_new_only(
        a.as_incoming(_event_stream(spark, d)), store, f"{store}/progress", a.WRITTEN_AT, f"{store}/results")
    return ingest.read_results(spark, f"{store}/results", "tags").groupBy("tag").agg(F.sum("count").alias("count"))
