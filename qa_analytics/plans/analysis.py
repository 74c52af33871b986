"""Whole runs: ingest a batch, analyse the result."""

from pyspark.sql import DataFrame

from ..operators import keywords, quality, sentiment, stats, tags, temporal
from ..operators.filters import analysis_scope, authors_of_questions, top_authors
from ..operators.writes import (
    WRITERS, touched_ids, update_only_authors, upsert_authors, write_metrics,
)


def ingest(questions: DataFrame, authors: DataFrame, batch: DataFrame, mode, as_of) -> dict:
    """Next question and author snapshots, run counts and touched ids of a batch in one of the three modes."""
    next_authors = update_only_authors if mode == "update" else upsert_authors
    return {
        "questions": WRITERS[mode](questions, batch, as_of),
        "authors": next_authors(authors, batch, as_of, questions, mode),
        "metrics": write_metrics(questions, authors, batch, mode),
        "touched_ids": touched_ids(questions, batch, mode),
    }


def analyse(questions: DataFrame, authors: DataFrame, as_of, ids: DataFrame = None, lexicon: DataFrame = None,
            stop_words=keywords.STOP_WORDS, lemmas: DataFrame = None) -> dict:
    """All result tables, for every question or for the listed ids only.

    Nothing to analyse gives the same tables, empty or zero. The tables are
    independent plans; each reads only the columns it needs.
    """
    scoped, status = analysis_scope(questions, ids)
    people = authors if ids is None else authors_of_questions(questions, authors, ids)
    corpus = keywords.question_texts(scoped)
    trends = tags.tag_trends(scoped, as_of)
    scores = keywords.question_scores(scoped, stop_words=stop_words, lemmas=lemmas)
    words = sentiment.default_lexicon(questions.sparkSession) if lexicon is None else lexicon
    moods = sentiment.sentiment_summary(corpus, words)
    content = quality.content_quality(scoped)
    return {
        "status": status,
        "date_range": temporal.date_range(scoped),
        "trending_tags": tags.trending_tags(trends),
        "top_tags": tags.top_tags(trends),
        "hourly_patterns": temporal.activity_patterns(scoped, "hour"),
        "weekday_patterns": temporal.activity_patterns(scoped, "day_of_week"),
        "monthly_patterns": temporal.activity_patterns(scoped, "month"),
        "activity_peaks": temporal.activity_peaks(scoped),
        "keywords": keywords.top_keywords(scores),
        "sentiment": moods,
        "content_quality": content,
        "length_stats": quality.length_stats(scoped),
        "top_authors": top_authors(people),
        "reputation_stats": stats.reputation_stats(people),
        "activity_stats": stats.activity_stats(people),
        "counter_stats": stats.counter_stats(scoped),
        "tag_summary": tags.tag_summary(scoped),
        "most_common_tags": tags.tag_frequency(scoped),
    }
