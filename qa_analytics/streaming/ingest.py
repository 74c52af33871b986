"""Incremental ingest (ST1, ST2, ST4).

A streaming store holds two tables laid out by hash buckets, with the number of
the last batch that wrote each row, and the changes that wait to be folded in:

    <store>/layout                              number of buckets
    <store>/{questions,authors}/bucket=<b>
    <store>/changes_{questions,authors}/batch_id=<n>/bucket=<b>

A trigger replaces the partitions of its own batch number, so a retried batch
counts once, and looks only at the buckets its ids fall into. When `FOLD_AFTER`
batches wait, the trigger folds them: only touched buckets are rewritten and
the folders of the folded batches are released, so their number is bounded. A
fold that is repeated after a failure changes nothing: rows know the last batch
they contain. The current table is the stored one merged with the waiting
changes when it is read.
"""

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.values import as_timestamp
from ..operators.filters import by_ids, not_in_ids, with_audit
from ..operators.tags import tag_frequency
from ..operators.writes import author_updates, latest_per_key
from ..schema import AUTHOR_FIELDS, AUTHOR_SCHEMA, QUESTION_FIELDS, QUESTION_SCHEMA, STORED_QUESTION_SCHEMA
from ..session import durable, exists, remove
from ..sources.buckets import BUCKETS, read_buckets, touched_buckets, write_buckets

FOLD_AFTER = 8
_BATCH = T.StructField("batch_id", T.LongType())
_SCHEMAS = {
    "questions": T.StructType([*STORED_QUESTION_SCHEMA.fields, _BATCH]),
    "authors": T.StructType([*AUTHOR_SCHEMA.fields, _BATCH]),
}
_KEYS = {"questions": "question_id", "authors": "author_name"}
_STORED = STORED_QUESTION_SCHEMA.fieldNames()


def question_stream(spark, folder, schema=QUESTION_SCHEMA, name_filter=None, files_per_trigger=None) -> DataFrame:
    """Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def payload_stream(spark, folder, schema, files_per_trigger=None) -> DataFrame:
    """JSON payload files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def seed_store(spark, store, questions: DataFrame = None, authors: DataFrame = None, buckets=BUCKETS) -> None:
    """Start a store, empty or from existing tables."""
    for table, rows in (("questions", questions), ("authors", authors)):
        rows = spark.createDataFrame([], _SCHEMAS[table]) if rows is None else rows.withColumn("batch_id", F.lit(-1).cast("long"))
        write_buckets(rows.select(*_SCHEMAS[table].fieldNames()), f"{store}/{table}", _KEYS[table], buckets)
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{store}/layout")


def _buckets(spark, store):
    if not exists(spark, f"{store}/layout/_SUCCESS"):
        seed_store(spark, store)
    return spark.read.schema("buckets int").parquet(f"{store}/layout").first()["buckets"]


def _changes(spark, store, table, wanted=None) -> DataFrame:
    path = f"{store}/changes_{table}"
    if not exists(spark, path):
        return spark.createDataFrame([], _SCHEMAS[table]).withColumn("bucket", F.lit(0))
    return read_buckets(spark, path, _SCHEMAS[table], wanted)


def _stored(spark, store, table, wanted=None) -> DataFrame:
    return read_buckets(spark, f"{store}/{table}", _SCHEMAS[table], wanted)


def _questions(old: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored rows without a change, and the latest change of every other id; only the changes are grouped."""
    latest = latest_per_key(changes.withColumn("seq", F.col("batch_id")))
    return not_in_ids(old, changes).select(*_STORED, "batch_id").unionByName(latest.select(*_STORED, "batch_id"))


def _authors(old: DataFrame, changes: DataFrame) -> DataFrame:
    """Counters add up, values come from the latest change; changes that a stored row contains already are left out."""
    contained = old.select("author_name", F.col("batch_id").alias("_upto"))
    waiting = changes.join(contained, "author_name", "left").where("_upto is null or batch_id > _upto")
    columns = [*AUTHOR_FIELDS, "batch_id"]
    last = F.struct("reputation", "profile_url", "last_seen")
    return old.select(*columns).unionByName(waiting.select(*columns)).groupBy("author_name").agg(
        F.max_by(last, "batch_id").alias("last"), F.sum("question_count").alias("question_count"),
        F.min_by("first_seen", "batch_id").alias("first_seen"), F.max("batch_id").alias("batch_id"),
    ).select("author_name", "last.*", "question_count", "first_seen", "batch_id").select(*columns)


_MERGED = {"questions": _questions, "authors": _authors}


def _current(spark, store, table):
    _buckets(spark, store)
    return _MERGED[table](_stored(spark, store, table), _changes(spark, store, table))


def current_questions(spark, store) -> DataFrame:
    """The question table."""
    return _current(spark, store, "questions").select(*_STORED)


def current_authors(spark, store) -> DataFrame:
    """The author table."""
    return _current(spark, store, "authors").select(*AUTHOR_FIELDS)


def stored_ids(spark, store, batch_id, wanted) -> DataFrame:
    """Ids that batches before `batch_id` wrote, from the wanted buckets only."""
    parts = [t.where(F.col("batch_id") < batch_id).select("question_id")
             for t in (_stored(spark, store, "questions", wanted), _changes(spark, store, "questions", wanted))]
    return parts[0].unionByName(parts[1])


def waiting_batches(spark, store):
    """Numbers of the batches that are not folded in; never many more than `FOLD_AFTER`."""
    numbers = _changes(spark, store, "questions").select("batch_id").unionByName(
        _changes(spark, store, "authors").select("batch_id")).distinct()
    return sorted(r["batch_id"] for r in numbers.collect())


def compact(spark, store) -> None:
    """Fold all waiting batches in: touched buckets are merged, staged and replaced, then the batches' folders go."""
    folded, buckets = waiting_batches(spark, store), _buckets(spark, store)
    for table, key in _KEYS.items():
        changes = _changes(spark, store, table).where(F.col("batch_id").isin(folded))
        touched = touched_buckets(changes, key, buckets)
        if touched:
            merged = _MERGED[table](_stored(spark, store, table, touched), changes)
            write_buckets(durable(merged), f"{store}/{table}", key, buckets)
    for n in folded:
        for table in _KEYS:
            remove(spark, f"{store}/changes_{table}/batch_id={n}")


def _write_changes(store, batch_id, questions, authors, as_of, buckets=BUCKETS):
    number, now = F.lit(batch_id).cast("long").alias("batch_id"), as_timestamp(as_of)
    people = authors.select(
        "author_name", "last.reputation", "last.profile_url", now.alias("last_seen"), F.col("rows").alias("question_count"),
        now.alias("first_seen"))
    for table, rows in (("authors", people), ("questions", questions)):
        write_buckets(rows.select("*", number), f"{store}/changes_{table}", _KEYS[table], buckets, "batch_id")


def _fold_when_due(spark, store, fold_after):
    if len(waiting_batches(spark, store)) >= fold_after:
        compact(spark, store)


def _run(source, each_batch, checkpoint):
    def with_batch_read_once(batch, batch_id):
        batch.persist()
        try:
            each_batch(batch, batch_id)
        finally:
            batch.unpersist()

    # A trigger without new files would only clear state; the next run does that as well.
    conf, name = source.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        query = (
            source.writeStream.foreachBatch(with_batch_read_once).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    finally:
        conf.set(name, before)
    query.awaitTermination()


def _delivered_once(source: DataFrame, within) -> DataFrame:
    """Rows without those that arrive again (same id and `seq`) within a while; the state keeps keys, not rows.

    The clock is that of arrival, so no row is late however old its question is.
    """
    return source.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within).dropDuplicatesWithinWatermark(
        ["question_id", "seq"]).drop("_arrived")


def _append_batch(batch, batch_id, store, as_of):
    """Write the rows of a batch whose id the store does not have yet; only the batch's buckets are looked at."""
    spark = batch.sparkSession
    buckets = _buckets(spark, store)
    ids = batch.select("question_id").distinct()
    known = by_ids(stored_ids(spark, store, batch_id, touched_buckets(ids, "question_id", buckets)), ids)
    new = durable(not_in_ids(batch, known))
    fresh = with_audit(latest_per_key(new).select(*QUESTION_FIELDS), as_of)
    _write_changes(store, batch_id, fresh, author_updates(new), as_of, buckets)


def stream_upsert(source: DataFrame, store, checkpoint, as_of, fold_after=FOLD_AFTER) -> None:
    """ST2: every trigger adds the batch's last row per id and its author counts. `source` carries `seq`."""

    def each_batch(batch, batch_id):
        spark = batch.sparkSession
        fresh = with_audit(latest_per_key(batch).select(*QUESTION_FIELDS), as_of)
        _write_changes(store, batch_id, fresh, author_updates(batch), as_of, _buckets(spark, store))
        _fold_when_due(spark, store, fold_after)

    _run(source, each_batch, checkpoint)


def stream_append(source: DataFrame, store, checkpoint, as_of, within="1 hour", fold_after=FOLD_AFTER) -> None:
    """ST1: every trigger adds the ids the store does not have yet; late rows count like any other."""

    def each_batch(batch, batch_id):
        _append_batch(batch, batch_id, store, as_of)
        _fold_when_due(batch.sparkSession, store, fold_after)

    _run(_delivered_once(source, within), each_batch, checkpoint)


def stream_new_only(source: DataFrame, store, checkpoint, as_of, results, within="1 hour", fold_after=FOLD_AFTER) -> None:
    """ST4: append, then analyse just the new questions of the trigger.

    Writes `<results>/batch=<n>/tags` with the tag counts of the new questions
    and `<results>/batch=<n>/status` with a row saying `analysed` or `skipped`.
    """

    def each_batch(batch, batch_id):
        spark = batch.sparkSession
        _append_batch(batch, batch_id, store, as_of)
        written = _changes(spark, store, "questions").where(F.col("batch_id") == batch_id)
        number = F.lit(batch_id).cast("long").alias("batch_id")
        tag_frequency(written, limit=None).select(number, "tag", "count").write.mode("overwrite").parquet(
            f"{results}/batch={batch_id}/tags")
        status = written.agg(F.count(F.lit(1)).alias("questions")).select(
            number, F.when(F.col("questions") > 0, "analysed").otherwise("skipped").alias("status"), "questions")
        status.write.mode("overwrite").parquet(f"{results}/batch={batch_id}/status")
        _fold_when_due(spark, store, fold_after)

    _run(_delivered_once(source, within), each_batch, checkpoint)


def read_results(spark, results, table) -> DataFrame:
    """All batches of a result table."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(
        f"{results}/batch=*/{table}")
