"""Full refresh of a question table from a snapshot."""

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import refresh_flags
from ..functions.values import percent, rate
from .filters import by_ids, first_rows, named_authors, not_in_ids
from .ranking import batch_numbers
from .writes import update_only_authors, update_only_questions


def bulk_lookup(ids: DataFrame, snapshot: DataFrame, batch_size=100) -> DataFrame:
    """Snapshot rows of the wanted ids, with the batch each id falls into. No id is left out."""
    return batch_numbers(ids, batch_size).join(snapshot, "question_id")


def refresh_batches(
    existing: DataFrame, authors: DataFrame, snapshot: DataFrame, batch_size=100,
    max_questions=None, dry_run=False, failed: DataFrame = None,
) -> DataFrame:
    """M8: one row per batch: processed, updated, errors, skipped, authors_updated.

    A batch with nothing in the snapshot is skipped as a whole; ids missing
    from a batch that found others count nowhere. `failed` lists ids whose
    lookup failed: their whole batch counts as errors. Snapshot rows are
    counted per id before the join.
    """
    ids = first_rows(existing.select("question_id"), max_questions, "question_id")
    batches = batch_numbers(ids, batch_size)
    zero = F.lit(0).cast("long")
    hits = snapshot.groupBy("question_id").agg(F.count(F.lit(1)).alias("found")).withColumn("authors", zero)
    by_author = named_authors(snapshot).groupBy("question_id", "author_name").agg(F.count(F.lit(1)).alias("authors"))
    touched = by_ids(by_author, authors, "author_name").select("question_id", zero.alias("found"), "authors")
    found = hits.unionByName(touched).groupBy("question_id").agg(
        F.sum("found").alias("found"), F.sum("authors").alias("authors"))
    rows = batches.join(found, "question_id", "left")
    if failed is None:
        rows = rows.withColumn("failed", F.lit(False))
    else:
        rows = rows.join(
            failed.select("question_id").distinct().withColumn("failed", F.lit(True)), "question_id", "left")
    per_batch = rows.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("processed"), F.coalesce(F.sum("found"), F.lit(0)).alias("found"),
        F.coalesce(F.sum("authors"), F.lit(0)).alias("authors"),
        F.coalesce(F.max("failed"), F.lit(False)).alias("failed"),
    )
    failed_batch, processed = F.col("failed"), F.col("processed")
    return per_batch.select(
        "batch_no", "processed",
        F.when(failed_batch, zero).otherwise(F.col("found")).alias("updated"),
        F.when(failed_batch, processed).otherwise(zero).alias("errors"),
        F.when(~failed_batch & (F.col("found") == 0), processed).otherwise(zero).alias("skipped"),
        F.when(failed_batch | F.lit(dry_run), zero).otherwise(F.col("authors")).alias("authors_updated"),
    )


def refreshed(existing: DataFrame, authors: DataFrame, snapshot: DataFrame, as_of, batch_size=100,
              dry_run=False, failed: DataFrame = None) -> dict:
    """M8: the next questions and authors of a refresh run and its counts per batch.

    Known questions and authors take the snapshot's values; a batch with a
    failed lookup and a dry run leave both as they are. `snapshot` has the
    question columns plus `seq`.
    """
    counts = refresh_batches(existing, authors, snapshot, batch_size, dry_run=dry_run, failed=failed)
    if dry_run:
        return {"questions": existing, "authors": authors, "batches": counts}
    if failed is not None:
        numbers = batch_numbers(existing.select("question_id"), batch_size)
        lost = by_ids(numbers, failed).select("batch_no").distinct()
        snapshot = not_in_ids(snapshot, numbers.join(lost, "batch_no", "left_semi"))
    return {
        "questions": update_only_questions(existing, snapshot, as_of),
        "authors": update_only_authors(authors, snapshot, as_of), "batches": counts,
    }


def refresh_rollup(batches: DataFrame, duration=None) -> DataFrame:
    """Totals over all batches and the success share; with a duration also the rate."""
    names = ("processed", "updated", "errors", "skipped", "authors_updated")
    total = batches.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
        F.count(F.lit(1)).alias("batches_completed"),
    ).withColumn("success_rate", percent(F.col("updated"), F.col("processed")))
    if duration is None:
        return total
    return total.withColumns({
        "duration": F.lit(float(duration)), "questions_per_second": rate(F.col("processed"), F.lit(float(duration)))})


def refresh_report(rollup: DataFrame) -> DataFrame:
    """Shares, time per question and recommendation flags of a rolled-up refresh with a rate."""
    processed = F.col("processed")
    report = rollup.withColumns({
        "error_rate": percent(F.col("errors"), processed),
        "skipped_rate": percent(F.col("skipped"), processed),
        "ms_per_question": rate(F.col("duration"), processed) * 1000,
    })
    return report.withColumns(refresh_flags(
        F.col("error_rate"), F.col("questions_per_second"), F.col("skipped"), F.col("updated")))
