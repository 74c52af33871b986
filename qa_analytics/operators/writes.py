"""Keyed writes as snapshot-to-snapshot functions.

`existing` and `authors` are the current snapshots; every function returns the
next one and leaves writing it (to a new path) to `sources.tables`. `batch`
has the question columns plus `seq`, the arrival order inside the batch.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.values import as_timestamp
from ..schema import AUTHOR_FIELDS, QUESTION_FIELDS
from .filters import by_ids, is_named, named_authors, not_in_ids, with_audit

MODES = ("upsert", "update", "append-only")


def latest_per_key(batch: DataFrame, key="question_id", seq="seq") -> DataFrame:
    """The last row of each key; partial aggregation absorbs a key that repeats a lot. No `seq` comes before any."""
    others = [c for c in batch.columns if c not in (key, seq)]
    arrival = F.struct(F.col(seq).isNotNull(), F.col(seq))
    last = batch.groupBy(key).agg(F.max_by(F.struct(*others), arrival).alias("_last"))
    return last.select(key, "_last.*")


def upsert_questions(existing: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """M1: listed ids are replaced, audit columns included; new ids are added."""
    fresh = with_audit(latest_per_key(batch).select(*QUESTION_FIELDS), as_of)
    return not_in_ids(existing, batch).unionByName(fresh)


def update_only_questions(existing: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """M2: known ids are replaced, unknown ones ignored. One left join, no second pass over `existing`."""
    fresh = with_audit(latest_per_key(batch).select(*QUESTION_FIELDS), as_of)
    values = [c for c in fresh.columns if c != "question_id"]
    packed = fresh.select("question_id", F.struct(*values).alias("_new"))
    return existing.join(packed, "question_id", "left").select("question_id", *[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values
    ])


def append_only_questions(existing: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """M3: unknown ids are added, known ones ignored."""
    return existing.unionByName(additions(existing, batch, as_of))


def additions(existing: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """The rows that an append-only run adds; a store that is a folder of files needs to write no more than these.

    The batch is reduced to a row per id before the join.
    """
    return with_audit(not_in_ids(latest_per_key(batch).select(*QUESTION_FIELDS), existing), as_of)


WRITERS = {"upsert": upsert_questions, "update": update_only_questions, "append-only": append_only_questions}


def effective_batch(existing: DataFrame, batch: DataFrame, mode) -> DataFrame:
    """The rows of a batch that a run in this mode stores (and whose authors it touches)."""
    if mode == "upsert":
        return batch
    return by_ids(batch, existing) if mode == "update" else not_in_ids(batch, existing)


def author_updates(batch: DataFrame, existing: DataFrame = None, mode="upsert") -> DataFrame:
    """Per real author the rows of the batch and the values of the last one.

    With `existing` only rows that a run in `mode` stores count. They are
    added up per question and author before that join, so a question that
    repeats a lot is one row there.
    """
    rows = named_authors(batch).select(
        "question_id", "author_name", F.lit(1).cast("long").alias("rows"), "seq",
        F.struct(F.col("author_reputation").alias("reputation"), F.col("author_profile_url").alias("profile_url")).alias("last"))
    if existing is not None and mode != "upsert":
        rows = effective_batch(existing, _added_up(rows, "question_id", "author_name"), mode)
    return _added_up(rows, "author_name").drop("seq")


def _added_up(rows, *keys):
    return rows.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.max_by("last", "seq").alias("last"), F.max("seq").alias("seq"))


def _merged_authors(authors, updates, as_of, how) -> DataFrame:
    now, seen = as_timestamp(as_of), F.col("rows").isNotNull()
    pick = lambda new, old: F.when(seen, new).otherwise(F.col(old)).alias(old)
    marked = authors.withColumn("_is_old", F.lit(True))
    return marked.join(updates, "author_name", how).select(
        "author_name",
        pick(F.col("last.reputation"), "reputation"),
        pick(F.col("last.profile_url"), "profile_url"),
        pick(now, "last_seen"),
        (F.coalesce("question_count", F.lit(0)) + F.coalesce("rows", F.lit(0))).alias("question_count"),
        F.coalesce("first_seen", F.when(F.col("_is_old").isNull(), now)).alias("first_seen"),
    ).select(*AUTHOR_FIELDS)


def upsert_authors(authors: DataFrame, batch: DataFrame, as_of, existing: DataFrame = None, mode="upsert") -> DataFrame:
    """M4: counts grow with every row, also of a question stored before; `first_seen` is set once."""
    return _merged_authors(authors, author_updates(batch, existing, mode), as_of, "full_outer")


def update_only_authors(authors: DataFrame, batch: DataFrame, as_of, existing: DataFrame = None, mode="update") -> DataFrame:
    """M5: known authors only."""
    return _merged_authors(authors, author_updates(batch, existing, mode), as_of, "left")


def write_metrics(existing: DataFrame, authors: DataFrame, batch: DataFrame, mode) -> DataFrame:
    """M6: one row of counts for a run in `mode` against the snapshots before it.

    One pass over the batch: it is added up per id and author, marked by
    whether the run stores it, added up per author, and all counts are taken
    from that. A repeated key is one row in every join. Only the first row of
    an unseen author is "new", its further rows are "updated".
    """
    rows = batch.groupBy("question_id", "author_name").agg(F.count(F.lit(1)).alias("n"))
    stores = F.lit(True)
    if mode != "upsert":
        held = existing.select("question_id").distinct().withColumn("_held", F.lit(True))
        rows = rows.join(held, "question_id", "left")
        stores = F.col("_held").isNotNull() if mode == "update" else F.col("_held").isNull()
    per_author = rows.groupBy("author_name").agg(
        F.sum("n").alias("attempted"), F.coalesce(F.sum(F.when(stores, F.col("n"))), F.lit(0)).alias("stored"))
    known = authors.select("author_name", F.lit(True).alias("_known"))
    touched = is_named(F.col("author_name")) & (F.col("stored") > 0)
    is_new = F.col("_known").isNull()
    if mode == "update":
        new, updated = F.lit(0).cast("long"), F.when(touched & ~is_new, F.col("stored"))
    else:
        new, updated = F.count_if(touched & is_new), F.when(touched, F.col("stored") - is_new.cast("long"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_author.join(known, "author_name", "left").agg(
        total("attempted").alias("questions_attempted"), total("stored").alias("questions_stored"),
        new.alias("authors_new"), total(updated).alias("authors_updated"))


def touched_ids(existing: DataFrame, batch: DataFrame, mode) -> DataFrame:
    """Distinct ids that a run in `mode` writes, against the snapshot before it."""
    return effective_batch(existing, batch.select("question_id").distinct(), mode)
