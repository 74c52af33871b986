"""General, author and run statistics."""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.values import percent, rate
from .filters import concat_batches
from .ranking import numeric_summary


def counter_stats(questions: DataFrame, columns=("vote_count", "view_count", "answer_count")) -> DataFrame:
    """A row per counter; `zero_rate` of the answers is the unanswered share in percent."""
    return numeric_summary(questions, list(columns)).select(
        "metric", "mean", "median", "min", "max", "std",
        percent(F.col("zeros"), F.col("total")).alias("zero_rate"),
    )


def vote_stats(questions: DataFrame) -> DataFrame:
    return counter_stats(questions, ["vote_count"]).select("mean", "median", "max", "std")


def view_stats(questions: DataFrame) -> DataFrame:
    return counter_stats(questions, ["view_count"]).select("mean", "median", "max", "std")


def answer_stats(questions: DataFrame) -> DataFrame:
    return counter_stats(questions, ["answer_count"]).select(
        "mean", "median", "max", F.col("zero_rate").alias("unanswered_rate")
    )


def reputation_stats(authors: DataFrame) -> DataFrame:
    """A12."""
    known = authors.select(F.coalesce("reputation", F.lit(0)).alias("reputation"))
    return numeric_summary(known, ["reputation"]).select("mean", "median", "max", "min")


def activity_stats(authors: DataFrame) -> DataFrame:
    """Questions per author, authors in all, the most active one (first name on ties)."""
    counted = authors.select("author_name", F.coalesce("question_count", F.lit(0)).alias("question_count"))
    best = F.min(F.struct((-F.col("question_count")).alias("negated"), F.col("author_name")))
    most = counted.agg(best.alias("best")).select(F.col("best.author_name").alias("most_active_author"))
    numbers = numeric_summary(counted, ["question_count"]).select(
        F.col("mean").alias("mean_questions_per_author"), F.col("median").alias("median_questions_per_author"),
        F.col("max").cast("long").alias("most_active_count"), F.col("total").alias("total_authors"),
    )
    # Two one-row results side by side.
    both = numbers.unionByName(most, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in (
        "mean_questions_per_author", "median_questions_per_author", "most_active_author", "most_active_count",
        "total_authors")])


def store_stats(questions: DataFrame, authors: DataFrame, analyses: DataFrame = None) -> DataFrame:
    """Rows of the three tables and the first and last publication date, one row."""
    parts = [
        questions.agg(
            F.count(F.lit(1)).alias("questions"), F.lit(0).cast("long").alias("authors"),
            F.lit(0).cast("long").alias("analyses"),
            F.min("publication_date").alias("first_date"), F.max("publication_date").alias("last_date"),
        )
    ]
    for name, table in (("authors", authors), ("analyses", analyses)):
        if table is not None:
            zero, none = F.lit(0).cast("long"), F.lit(None).cast("timestamp")
            parts.append(table.agg(F.count(F.lit(1)).alias("n")).select(
                zero.alias("questions"),
                (F.col("n") if name == "authors" else zero).alias("authors"),
                (F.col("n") if name == "analyses" else zero).alias("analyses"),
                none.alias("first_date"), none.alias("last_date"),
            ))
    return concat_batches(parts).agg(
        F.sum("questions").alias("questions"), F.sum("authors").alias("authors"), F.sum("analyses").alias("analyses"),
        F.max("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
    )


def batch_distincts(questions: DataFrame, approximate=False) -> DataFrame:
    """Distinct non-empty author names (the unknown one counts) and distinct tags.

    Exact by default: distinct rows are counted, which spreads over all tasks.
    """
    members = questions.select(F.explode(F.concat(
        F.transform(F.coalesce("tags", F.array().cast("array<string>")),
                    lambda t: F.struct(F.lit("tag").alias("kind"), t.alias("name"))),
        F.array(F.struct(F.lit("author").alias("kind"), F.col("author_name").alias("name"))),
    )).alias("m")).select("m.kind", "m.name").where(F.col("name").isNotNull())
    members = members.where((F.col("kind") == "tag") | (F.col("name") != ""))
    kind = F.col("kind")
    if approximate:
        count = lambda k: F.approx_count_distinct(F.when(kind == k, F.col("name")))
    else:
        members = members.distinct()
        count = lambda k: F.count_if(kind == k)
    return members.agg(count("author").alias("unique_authors"), count("tag").alias("unique_tags"))


def run_metrics(counts: DataFrame, duration) -> DataFrame:
    """Rates of a run from its one-row counts.

    `counts` has questions_attempted, questions_stored, authors_new and
    authors_updated; `duration` is in seconds (0 gives rate 0).
    """
    seconds = F.lit(float(duration)) if not hasattr(duration, "alias") else duration
    stored, attempted = F.col("questions_stored"), F.col("questions_attempted")
    return counts.select(
        "questions_attempted", "questions_stored", "authors_new", "authors_updated",
        (F.col("authors_new") + F.col("authors_updated")).alias("authors_total"),
        seconds.alias("storage_duration"), rate(stored, seconds).alias("storage_rate"),
        percent(stored, attempted).alias("efficiency"), (attempted - stored).alias("questions_ignored"),
    )


def phase_share(phases: DataFrame) -> DataFrame:
    """Share of each phase in the total time, from any number of (phase, seconds) rows."""
    # Phases are a handful of summed rows, so the one window task is small.
    total = F.sum("seconds").over(Window.partitionBy())
    return phases.groupBy("phase").agg(F.sum("seconds").alias("seconds")).select(
        "phase", "seconds", percent(F.col("seconds"), total).alias("share")
    )
