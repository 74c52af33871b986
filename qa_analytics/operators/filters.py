"""Filters, key lookups and ordered retrieval."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import is_blank
from ..functions.values import as_timestamp, iso_text
from ..schema import QUESTION_SCHEMA, UNKNOWN_AUTHOR
from .ranking import with_position

def with_defaults(df: DataFrame) -> DataFrame:
    """Every question column present and typed; null text is '', null numbers 0, null tags []."""
    out = []
    for field in QUESTION_SCHEMA.fields:
        kind = field.dataType.simpleString()
        col = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name == "author_name":
            col = F.coalesce(col, F.lit(UNKNOWN_AUTHOR))
        elif kind == "string":
            col = F.coalesce(col, F.lit(""))
        elif kind == "bigint":
            col = F.coalesce(col, F.lit(0).cast("long"))
        elif kind.startswith("array"):
            col = F.coalesce(col, F.array().cast(field.dataType))
        out.append(col.alias(field.name))
    extra = [F.col(c) for c in df.columns if c not in QUESTION_SCHEMA.fieldNames()]
    return df.select(*out, *extra)


def valid_dates(df: DataFrame, text_column, name="publication_date") -> DataFrame:
    """Parse an ISO text date; rows without a readable date go."""
    return df.withColumn(name, iso_text(F.col(text_column))).where(F.col(name).isNotNull())


def matching(df: DataFrame, condition=None) -> DataFrame:
    """A Column or SQL text; no condition keeps everything."""
    return df if condition is None else df.where(condition)


def field_exists(df: DataFrame, field) -> DataFrame:
    """P6 for typed columns: an explicit null and a missing field are the same thing here."""
    return df.where(F.col(field).isNotNull())


def is_named(column):
    """Whether a name is a real one; never null."""
    return F.coalesce(~is_blank(column) & (column != UNKNOWN_AUTHOR), F.lit(False))


def named_authors(df: DataFrame, column="author_name") -> DataFrame:
    """Rows that carry a real author name."""
    return df.where(is_named(F.col(column)))


def not_blank(df: DataFrame, column) -> DataFrame:
    """P9."""
    return df.where(~is_blank(F.col(column)))


def with_audit(df: DataFrame, as_of) -> DataFrame:
    """P10."""
    return df.withColumns({"stored_at": as_timestamp(as_of), "last_updated": as_timestamp(as_of)})


def newest_first(df: DataFrame, limit, skip=0) -> DataFrame:
    """Newest rows first, id ascending on ties, undated rows last; `limit=None` keeps all.

    With `limit=None` no order is applied: a total order over an unbounded
    table is left to whoever writes it out.
    """
    order = (F.col("publication_date").desc_nulls_last(), F.col("question_id"))
    if limit is None:
        if not skip:
            return df
        return with_position(df, *order, name="_position").where(F.col("_position") >= skip).drop("_position")
    ordered = df.orderBy(*order)
    return (ordered.offset(skip) if skip else ordered).limit(limit)


def first_rows(df: DataFrame, n, *order) -> DataFrame:
    """Cap at the first `n` rows of a stated order; `None` keeps all."""
    return df if n is None else df.orderBy(*order).limit(n)


def by_ids(df: DataFrame, ids: DataFrame, key="question_id") -> DataFrame:
    """Rows whose key is listed; no listed key, no row. A key listed often is one row in the join."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def not_in_ids(df: DataFrame, ids: DataFrame, key="question_id") -> DataFrame:
    """Rows whose key is not listed."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def with_tags(df: DataFrame, tags, match="any", limit=None) -> DataFrame:
    """Rows with any or all of the tags; with a limit the newest ones."""
    wanted = F.array(*[F.lit(t) for t in tags]).cast("array<string>")
    if match == "any":
        hit = F.arrays_overlap(F.col("tags"), wanted)
    elif match == "all":
        hit = F.size(F.array_except(wanted, F.col("tags"))) == 0
    else:
        raise ValueError("match is 'any' or 'all'")
    return newest_first(df.where(hit), limit)


def in_date_range(df: DataFrame, start, end, limit=None) -> DataFrame:
    """P5: both ends included; with a limit the newest rows."""
    return newest_first(
        df.where(F.col("publication_date").between(as_timestamp(start), as_timestamp(end))), limit
    )


def question_ids(df: DataFrame) -> DataFrame:
    """S5."""
    return df.select("question_id")


def edge_questions(df: DataFrame) -> DataFrame:
    """One row with the oldest and the newest question."""
    dated = df.where(F.col("publication_date").isNotNull())
    at, key = F.col("publication_date"), F.col("question_id")
    return dated.agg(
        F.min(F.struct(at, key)).alias("first"), F.min_by(key, F.struct(-F.unix_micros(at), key)).alias("last_id"),
        F.max(at).alias("last_at"),
    ).select(
        F.col("first.question_id").alias("first_id"), F.col("first.publication_date").alias("first_date"),
        "last_id", F.col("last_at").alias("last_date"),
    )


def distinct_authors(df: DataFrame) -> DataFrame:
    """Distinct real author names."""
    return named_authors(df).select("author_name").distinct()


def authors_of_questions(questions: DataFrame, authors: DataFrame, ids: DataFrame) -> DataFrame:
    """Author rows of the listed questions (most active first when ordered by the caller).

    Names are made distinct before the join, so an author with very many
    questions costs one row there.
    """
    names = distinct_authors(by_ids(questions.select("question_id", "author_name"), ids))
    return authors.join(names, "author_name", "left_semi")


def top_authors(authors: DataFrame, limit=10) -> DataFrame:
    """T2."""
    return first_rows(authors, limit, F.col("question_count").desc_nulls_last(), F.col("author_name"))


def concat_batches(batches) -> DataFrame:
    """Duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b), batches)


def batch_members(df: DataFrame) -> DataFrame:
    """The distinct tags and author names of a batch as (kind, name)."""
    tags = df.select(F.lit("tag").alias("kind"), F.explode("tags").alias("name"))
    authors = df.select(F.lit("author").alias("kind"), F.col("author_name").alias("name"))
    return tags.unionByName(authors.where(F.col("name") != "")).distinct()


def id_sets(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Each distinct incoming id with its state, `existing` or `new`."""
    ids = incoming.select("question_id").distinct()
    known = existing.select("question_id", F.lit(True).alias("known")).distinct()
    return ids.join(known, "question_id", "left").select(
        "question_id", F.when(F.col("known"), "existing").otherwise("new").alias("state")
    )


def analysis_scope(questions: DataFrame, ids: DataFrame = None):
    """(questions to analyse, status row).

    `ids=None` means everything. An empty id set means nothing to analyse:
    the frame is empty and the status is `skipped`.
    """
    if ids is None:
        scoped, mode = questions, "all"
    else:
        scoped, mode = by_ids(questions, ids), "new-only"
    some = F.count(F.lit(1)) > 0
    status = scoped.agg(some.alias("some")).select(
        F.lit(mode).alias("scope"), F.when(F.col("some"), "analysed").otherwise("skipped").alias("status"))
    return scoped, status


def ranked(df: DataFrame, n, *order) -> DataFrame:
    """The first `n` rows of an order with their rank.

    The window has no partition key, but only the `n` rows kept reach it.
    """
    return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))

