"""Tables laid out by a hash bucket of their key (M1-M3).

A table is a folder with one partition per bucket. A keyed write finds out
which buckets its batch falls into (at most as many numbers as there are
buckets), reads only those and replaces only those; an append adds files to
them. Rows that a write replaces are staged in the shared folder first, so the
step that swaps partitions never reads what it replaces and can be repeated
after a failure with the same result.

The number of buckets is fixed when a table is made: choose it so that a bucket
is a few hundred megabytes (the default suits a table of a few gigabytes).
"""

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.filters import by_ids
from ..operators.writes import additions, update_only_questions, upsert_questions
from ..schema import STORED_QUESTION_SCHEMA
from ..session import durable

BUCKETS = 8
KEY = "question_id"


def bucket_of(key, buckets):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def with_bucket_column(schema):
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])


def write_buckets(rows: DataFrame, path, key, buckets, *parts, mode="overwrite") -> None:
    """Replace the partitions that `rows` falls into, or add to them (`mode="append"`); others stay untouched.

    `parts` are further partition columns before the bucket.
    """
    placed = rows.withColumn("bucket", bucket_of(F.col(key), buckets))
    placed.repartition("bucket").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        *parts, "bucket").parquet(path)


def read_buckets(spark, path, schema, wanted=None) -> DataFrame:
    """The table with its `bucket` column; with a list of buckets only their files are read."""
    table = spark.read.schema(with_bucket_column(schema)).parquet(path)
    return table if wanted is None else table.where(F.col("bucket").isin(wanted))


def touched_buckets(batch: DataFrame, key, buckets):
    """The buckets of a batch's keys, as numbers: never more than there are buckets."""
    found = batch.select(bucket_of(F.col(key), buckets).alias("bucket")).distinct()
    return sorted(r["bucket"] for r in found.collect())


def stored_questions(spark, path) -> DataFrame:
    """The whole table."""
    return read_buckets(spark, path, STORED_QUESTION_SCHEMA).drop("bucket")


def create_store(questions: DataFrame, path, buckets=BUCKETS) -> None:
    write_buckets(questions.select(*STORED_QUESTION_SCHEMA.fieldNames()), path, KEY, buckets)


def upsert_into(spark, path, batch: DataFrame, as_of, buckets=BUCKETS) -> None:
    """M1: the buckets of the batch are merged with it and replaced."""
    old = read_buckets(spark, path, STORED_QUESTION_SCHEMA, touched_buckets(batch, KEY, buckets)).drop("bucket")
    write_buckets(durable(upsert_questions(old, batch, as_of)), path, KEY, buckets)


def update_in(spark, path, batch: DataFrame, as_of, buckets=BUCKETS) -> None:
    """M2: only buckets that hold a listed id are replaced; a batch of unknown ids writes nothing."""
    ids = batch.select(KEY).distinct()
    held = read_buckets(spark, path, STORED_QUESTION_SCHEMA, touched_buckets(ids, KEY, buckets))
    old = held.where(F.col("bucket").isin(touched_buckets(by_ids(held.select(KEY), ids), KEY, buckets))).drop("bucket")
    write_buckets(durable(update_only_questions(old, batch, as_of)), path, KEY, buckets)


def append_to(spark, path, batch: DataFrame, as_of, buckets=BUCKETS) -> None:
    """M3: unknown ids are written next to the files of their buckets; nothing is rewritten."""
    held = read_buckets(spark, path, STORED_QUESTION_SCHEMA, touched_buckets(batch, KEY, buckets)).select(KEY)
    write_buckets(durable(additions(held, batch, as_of)), path, KEY, buckets, mode="append")
