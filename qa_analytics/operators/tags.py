"""Tag statistics and trends."""

from pyspark.sql import DataFrame, functions as F

from ..functions.values import days_before, rate

# Trend periods in days.
PERIODS = {"last_week": 7, "last_month": 30, "last_quarter": 90, "last_year": 365}
OLDER_FROM, OLDER_TO = 60, 30


def tag_statistics(questions: DataFrame, limit=50) -> DataFrame:
    """A1: questions, mean votes and mean views per tag, most frequent first."""
    stats = (
        questions.select(F.explode("tags").alias("tag"), "vote_count", "view_count")
        .groupBy("tag").agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("vote_count").alias("avg_votes"),
            F.avg("view_count").alias("avg_views"),
        )
    )
    return stats if limit is None else stats.orderBy(F.desc("count"), "tag").limit(limit)


def tag_frequency(questions: DataFrame, limit=20) -> DataFrame:
    """A2: most common tags; repeats inside a question count."""
    counts = questions.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("count"))
    return counts if limit is None else counts.orderBy(F.desc("count"), "tag").limit(limit)


def tag_summary(questions: DataFrame) -> DataFrame:
    """A2: distinct tags and tags per question over all questions, untagged ones included.

    One pass: the outer explode keeps a row for an untagged question, and the
    first position of each question stands for the question.
    """
    per_tag = (
        questions.select(F.posexplode_outer("tags").alias("pos", "tag"))
        .groupBy("tag").agg(
            F.count("tag").alias("uses"),
            F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("questions"),
        )
    )
    return per_tag.agg(
        F.count("tag").alias("total_unique_tags"),
        F.coalesce(F.sum("uses"), F.lit(0)).alias("total_tags"),
        F.coalesce(F.sum("questions"), F.lit(0)).alias("total_questions"),
    ).select("*", rate(F.col("total_tags"), F.col("total_questions")).alias("average_tags_per_question"))


def tag_trends(questions: DataFrame, as_of) -> DataFrame:
    """A3, A4: per tag the total, the count since each period began and the growth rate.

    Undated questions are left out, from the totals too. Growth compares the
    last 30 days with the 30 days before them; with nothing before, it is 0.
    """
    at = F.col("publication_date")
    dated = questions.where(at.isNotNull()).select(at, F.explode("tags").alias("tag"))
    since = [F.count_if(at >= days_before(as_of, days)).alias(name) for name, days in PERIODS.items()]
    older = F.count_if((at >= days_before(as_of, OLDER_FROM)) & (at < days_before(as_of, OLDER_TO)))
    recent, before = F.col("last_month"), F.col("_older")
    return (
        dated.groupBy("tag").agg(F.count(F.lit(1)).alias("total_questions"), *since, older.alias("_older"))
        .withColumn("growth_rate", F.when(before > 0, (recent - before) / before * 100).otherwise(F.lit(0.0)))
        .drop("_older")
    )


def trending_tags(trends: DataFrame, limit=20) -> DataFrame:
    """T3."""
    return trends.orderBy(F.desc("growth_rate"), F.desc("last_month"), "tag").limit(limit)


def top_tags(trends: DataFrame, limit=20) -> DataFrame:
    """T4."""
    return trends.orderBy(F.desc("total_questions"), "tag").limit(limit)


def declining_tags(trends: DataFrame) -> DataFrame:
    """Tags whose growth is negative."""
    return trends.where(F.col("growth_rate") < 0)

