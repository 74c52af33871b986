"""Report tables (S9): ranked, labelled and bounded."""

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import activity_band
from .filters import ranked
from .keywords import top_keywords
from .quality import quality_bands
from .sentiment import sentiment_share

# Rows of each ranked report table.
TREND_ROWS, TAG_ROWS, AUTHOR_ROWS = 15, 15, 10
KEYWORD_ROWS = {"title": 15, "summary": 15, "combined": 20}


def trending_table(trends: DataFrame) -> DataFrame:
    return ranked(trends, TREND_ROWS, F.desc("growth_rate"), F.desc("last_month"), F.col("tag")).select(
        "rank", "tag", "growth_rate", "total_questions", "last_week", "last_month")


def common_tags_table(tag_counts: DataFrame) -> DataFrame:
    return ranked(tag_counts, TAG_ROWS, F.desc("count"), F.col("tag")).select("rank", "tag", "count")


def keyword_table(scores: DataFrame) -> DataFrame:
    return top_keywords(scores, KEYWORD_ROWS)


def author_table(authors: DataFrame) -> DataFrame:
    """B8."""
    return ranked(authors, AUTHOR_ROWS, F.desc("question_count"), F.col("author_name")).select(
        "rank", "author_name", "reputation", "question_count", activity_band(F.col("question_count")).alias("activity"))


def report_tables(trends=None, tag_counts=None, authors=None, keywords=None, sentiment=None,
                  quality=None, counters=None) -> dict:
    """The tables of a report for the parts that were computed."""
    tables = {}
    if trends is not None:
        tables["trending_tags"] = trending_table(trends)
    if tag_counts is not None:
        tables["common_tags"] = common_tags_table(tag_counts)
    if authors is not None:
        tables["top_authors"] = author_table(authors)
    if keywords is not None:
        tables["keywords"] = keyword_table(keywords)
    if sentiment is not None:
        tables["sentiment"] = sentiment_share(sentiment)
    if quality is not None:
        tables["quality"] = quality_bands(quality)
    if counters is not None:
        tables["counters"] = counters
    return tables


def long_format(tables) -> DataFrame:
    """(section, entry) rows of several report tables, each entry as JSON text."""
    rows = None
    for name, table in tables.items():
        row = table.select(F.lit(name).alias("section"), F.to_json(F.struct(*table.columns)).alias("entry"))
        rows = row if rows is None else rows.unionByName(row)
    return rows
