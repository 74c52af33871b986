"""JSON payload ingest."""

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.text import body_summary
from ..functions.values import epoch_timestamp
from ..operators.filters import first_rows
from ..schema import PAYLOAD_SCHEMA, QUESTION_FIELDS, UNKNOWN_AUTHOR


def read_payloads(spark, path, multiline=False) -> DataFrame:
    """Payload files, one response object per line (or per file with `multiline`)."""
    return spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", multiline).json(path)


def parse_payloads(df: DataFrame, column) -> DataFrame:
    """S2 for payloads held in a text column."""
    return df.select(F.from_json(F.col(column), PAYLOAD_SCHEMA).alias("payload")).select("payload.*")


def unreadable_payloads(df: DataFrame, column) -> DataFrame:
    """One row with the pages seen and those whose text is no readable payload."""
    marked = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json(F.col(column), marked, {"columnNameOfCorruptRecord": "_broken"})
    broken = F.col(column).isNull() | parsed["_broken"].isNotNull()
    return df.select(broken.alias("broken")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("broken").alias("unreadable"))


def payload_questions(payloads: DataFrame, max_questions=None, summary_limit=None) -> DataFrame:
    """One flat question per item, newest first when capped; empty pages give nothing.

    Summaries are whole unless a `summary_limit` is asked for.
    """
    item = payloads.select(F.explode("items").alias("i")).select("i.*")
    text = lambda path, default="": F.coalesce(F.col(path), F.lit(default))
    number = lambda path: F.coalesce(F.col(path), F.lit(0).cast("long"))
    questions = item.select(
        number("question_id").alias("question_id"),
        text("title").alias("title"),
        text("link").alias("url"),
        body_summary(F.col("body"), summary_limit).alias("summary"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        text("owner.display_name", UNKNOWN_AUTHOR).alias("author_name"),
        number("owner.reputation").alias("author_reputation"),
        text("owner.link").alias("author_profile_url"),
        epoch_timestamp(F.col("creation_date")).alias("publication_date"),
        number("view_count").alias("view_count"),
        number("score").alias("vote_count"),
        number("answer_count").alias("answer_count"),
    )
    return first_rows(
        questions, max_questions, F.col("publication_date").desc(), F.col("question_id")
    ).select(*QUESTION_FIELDS)
