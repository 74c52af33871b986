"""Physical plans that must stay the way they are for large data."""

import pytest
from pyspark.sql import functions as F

from qa_analytics.operators import filters, keywords, ranking, sentiment, tags, writes
from qa_analytics.plans import adapters
from qa_analytics.plans.catalog import QUERIES
from qa_analytics.session import staging_path
from qa_analytics.sources import buckets, tables
from qa_analytics.streaming import ingest as streams

SF_DIR = "/root/testdata/sf0.001"
STREAMS = {name for name in QUERIES if name.startswith("stream_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    path = staging_path(spark, "plan-test")
    adapters.existing(spark, SF_DIR).write.parquet(path)
    return tables.read_questions(spark, path)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text
    assert ("MapInPandas" in text) == name.startswith("listing_")


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(filters.in_date_range(stored, "2024-01-02", "2024-01-03", 10).select("question_id"))
    assert "PushedFilters: [IsNotNull(publication_date), GreaterThanOrEqual(publication_date" in text
    assert "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<question_id:bigint>" in plan(filters.question_ids(stored))
    trends = plan(tags.trending_tags(tags.tag_trends(stored, "2024-02-01")))
    assert "ReadSchema: struct<tags:array<string>,publication_date:timestamp>" in trends
    assert "PushedFilters: [IsNotNull(publication_date)" in trends


def test_one_shuffle_per_tag_report(stored):
    text = plan(tags.tag_trends(stored, "2024-02-01"))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text
    assert plan(tags.tag_summary(stored)).count("Exchange hashpartitioning") == 1


def test_known_ids_are_read_without_other_columns(spark, stored):
    batch = adapters.incoming(spark, SF_DIR)
    scans = [line for line in plan(writes.touched_ids(stored, batch, "update")).split("\n") if "FileScan" in line]
    assert any("ReadSchema: struct<question_id:bigint>" in s for s in scans)


def test_text_is_cleaned_once_per_pass(spark):
    corpus = keywords.question_texts(adapters.q_docs(spark, SF_DIR), ("summary",))
    text = plan(keywords.term_frequencies(keywords.tokenised(corpus)))
    assert text.count("regexp_replace(regexp_replace(regexp_replace(") == 1


def test_a_write_of_a_hundred_ids_reads_only_their_buckets(spark):
    path = staging_path(spark, "plan-test") + "/questions"
    adapters.existing(spark, SF_DIR).transform(lambda q: buckets.create_store(q, path, 256) or q)
    ids = spark.range(100).select(F.col("id").alias("question_id"))
    touched = buckets.touched_buckets(ids, "question_id", 256)
    old = buckets.read_buckets(spark, path, tables.STORED_QUESTION_SCHEMA, touched)
    text = plan(old)
    assert len(touched) <= 100 and "PartitionFilters: [bucket#" in text and " INSET " in text.split("PartitionFilters")[1]
    read = old.select("bucket").distinct().collect()
    assert {r.bucket for r in read} <= set(touched)
    assert len(old.inputFiles()) > len(old.select(F.input_file_name()).distinct().collect())


def test_a_trigger_looks_up_ids_in_its_buckets_only(spark):
    store = staging_path(spark, "plan-test")
    streams.seed_store(spark, store, adapters.existing(spark, SF_DIR), adapters.authors0(spark, SF_DIR), buckets=16)
    lines = [x for x in plan(streams.stored_ids(spark, store, 5, [3, 4])).split("\n") if "FileScan" in x]
    assert lines and all("PartitionFilters: [bucket#" in x for x in lines)
    assert all("ReadSchema: struct<question_id:bigint,batch_id:bigint>" in x for x in lines)


def test_texts_are_scored_in_their_row(spark):
    corpus = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(
        F.lit("summary").alias("source"), F.col("doc_id").alias("doc"), "text")
    lexicon = sentiment.default_lexicon(spark)
    assert "Exchange" not in plan(sentiment.text_polarity(corpus, lexicon))
    text = plan(sentiment.sentiment_summary(corpus, lexicon))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    text = plan(keywords.keyword_scores(corpus, {"summary": 50}))
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "doc" not in exchanges[0] and "row" not in exchanges[0]


@pytest.mark.parametrize("mode", writes.MODES)
def test_write_metrics_read_the_batch_once(spark, stored, mode):
    path = staging_path(spark, "plan-test")
    adapters.incoming(spark, SF_DIR).write.parquet(path)
    new = spark.read.parquet(path)
    text = plan(writes.write_metrics(stored, adapters.authors0(spark, SF_DIR), new, mode))
    folder = path.rsplit("/", 1)[1]
    assert text.count(folder) == 1


def test_medians_run_no_job_and_write_nothing_while_planned(spark, stored):
    group = "planning of medians"
    spark.sparkContext.setJobGroup(group, group)
    text = plan(ranking.numeric_summary(stored, ["vote_count", "view_count", "answer_count"]))
    started = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(started) == []
    assert "rangepartitioning" not in text
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert scans and all("title" not in line and "view_count:bigint" in line for line in scans)


def test_events_move_to_their_page_before_the_cards_are_written(spark):
    """F2, F3."""
    lines = [x for x in plan(adapters.listing_pages(spark, SF_DIR)).split("\n") if "Exchange " in x]
    assert len(lines) == 1 and "event_id" in lines[0]
