"""Content quality and length (A16-A20, B3-B7): plain aggregates over one scan."""

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import (
    CLARITY_BANDS, COMPLETENESS_BANDS, DEPTH_BANDS, RICHNESS_BANDS, WORDS_BANDS, band,
)
from ..functions.text import contains_any, count_words_in, strip, terms_present, text_or_empty, word_count
from ..functions.values import percent, rate
from ..functions.word_lists import ADVANCED_TERMS, CODE_SIGNS, QUESTION_SIGNS, TECHNICAL_TERMS


def content_quality(
    questions: DataFrame, technical_terms=TECHNICAL_TERMS, advanced_terms=ADVANCED_TERMS,
    question_signs=QUESTION_SIGNS, code_signs=CODE_SIGNS, min_summary=50,
) -> DataFrame:
    """A16-A19, one row.

    Technical depth counts topics, not questions, so it may exceed 100.
    Question and code signs match inside words.
    """
    title, summary = text_or_empty(F.col("title")), text_or_empty(F.col("summary"))
    rows = questions.select(
        summary.alias("summary"), F.lower(F.concat(title, F.lit(" "), summary)).alias("text"))
    text = F.col("text")
    clear = contains_any(text, question_signs) & contains_any(text, code_signs)
    sums = rows.agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if(F.length(strip(F.col("summary"))) > min_summary).alias("complete"),
        F.coalesce(F.sum(word_count(text)), F.lit(0)).alias("words"),
        F.coalesce(F.sum(count_words_in(text, technical_terms)), F.lit(0)).alias("technical"),
        F.coalesce(F.sum(terms_present(text, advanced_terms)), F.lit(0)).alias("advanced"),
        F.count_if(clear).alias("clear"),
    )
    n = F.col("questions")
    return sums.select(
        percent(F.col("complete"), n).alias("summary_completeness"),
        percent(F.col("technical"), F.greatest(F.col("words"), F.lit(1))).alias("technical_word_ratio"),
        rate(F.col("words"), n).alias("avg_words_per_question"),
        F.col("technical").alias("technical_term_count"),
        percent(F.col("advanced"), n).alias("technical_depth"),
        percent(F.col("clear"), n).alias("clear_questions_ratio"),
        F.col("clear").alias("questions_with_context"),
    )


def quality_bands(quality: DataFrame) -> DataFrame:
    """(metric, value, band) rows."""
    bands = {
        "summary_completeness": COMPLETENESS_BANDS, "technical_word_ratio": RICHNESS_BANDS,
        "avg_words_per_question": WORDS_BANDS, "technical_depth": DEPTH_BANDS,
        "clear_questions_ratio": CLARITY_BANDS,
    }
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), band(F.col(m), b).alias("band"))
        for m, b in bands.items()
    ]
    return quality.select(F.inline(F.array(*rows)))


def length_stats(questions: DataFrame) -> DataFrame:
    """Mean characters and words of the non-empty titles and summaries; 0 without any."""

    def mean(col, measure):
        return F.coalesce(F.avg(F.when(F.col(col) != "", measure(F.col(col)))), F.lit(0.0))

    return questions.agg(
        mean("title", F.length).alias("average_title_length"),
        mean("summary", F.length).alias("average_summary_length"),
        mean("title", word_count).alias("title_word_count"),
        mean("summary", word_count).alias("summary_word_count"),
    )
