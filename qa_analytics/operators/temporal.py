"""Activity by hour, weekday and month."""

from pyspark.sql import DataFrame, functions as F

from ..functions.values import round_cents, weekday_name

_UNITS = {"hour": F.hour, "day_of_week": F.weekday, "month": F.month}


def activity_patterns(questions: DataFrame, unit) -> DataFrame:
    """Per hour, weekday (Monday is 0) or month of the year: votes counted, mean votes, views, answers."""
    dated = questions.where(F.col("publication_date").isNotNull())
    mean = lambda c: round_cents(F.avg(c))
    return dated.groupBy(_UNITS[unit]("publication_date").alias(unit)).agg(
        F.count("vote_count").alias("votes_count"), mean("vote_count").alias("votes_mean"),
        mean("view_count").alias("views_mean"), mean("answer_count").alias("answers_mean"),
    )


def activity_peaks(questions: DataFrame) -> DataFrame:
    """Busiest hour and weekday, the smallest on ties; one row, null peaks for no input.

    One pass builds at most 24 x 7 counts; both peaks come from them.
    """
    slots = (
        questions.where(F.col("publication_date").isNotNull())
        .groupBy(F.hour("publication_date").alias("hour"), F.weekday("publication_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kinds = F.array(
        F.struct(F.lit("hour").alias("kind"), F.col("hour").alias("slot")),
        F.struct(F.lit("day").alias("kind"), F.col("day").alias("slot")),
    )
    totals = slots.select(F.inline(kinds), "n").groupBy("kind", "slot").agg(F.sum("n").alias("n"))

    def peak(kind):
        rank = F.when(F.col("kind") == kind, F.struct(F.col("n"), -F.col("slot")))
        return F.max_by("slot", rank)

    return totals.agg(
        peak("hour").cast("long").alias("peak_hour"), peak("day").cast("long").alias("peak_day"),
        F.coalesce(F.sum(F.when(F.col("kind") == "hour", F.col("n"))), F.lit(0)).alias("total_questions_analyzed"),
    ).select("peak_hour", "peak_day", weekday_name(F.col("peak_day")).alias("peak_day_name"), "total_questions_analyzed")


def date_range(questions: DataFrame) -> DataFrame:
    """ISO texts of the first and last date, nulls for no input."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return questions.agg(
        iso(F.min("publication_date")).alias("start"), iso(F.max("publication_date")).alias("end")
    )
