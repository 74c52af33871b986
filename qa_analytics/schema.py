"""Table and payload schemas."""

from pyspark.sql import types as T

QUESTION_SCHEMA = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("author_name", T.StringType()),
    T.StructField("author_reputation", T.LongType()),
    T.StructField("author_profile_url", T.StringType()),
    T.StructField("publication_date", T.TimestampType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("answer_count", T.LongType()),
])

AUDIT_FIELDS = [
    T.StructField("stored_at", T.TimestampType()),
    T.StructField("last_updated", T.TimestampType()),
]

STORED_QUESTION_SCHEMA = T.StructType(QUESTION_SCHEMA.fields + AUDIT_FIELDS)

AUTHOR_SCHEMA = T.StructType([
    T.StructField("author_name", T.StringType()),
    T.StructField("reputation", T.LongType()),
    T.StructField("profile_url", T.StringType()),
    T.StructField("last_seen", T.TimestampType()),
    T.StructField("question_count", T.LongType()),
    T.StructField("first_seen", T.TimestampType()),
])

PAYLOAD_ITEM_SCHEMA = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("owner", T.StructType([
        T.StructField("display_name", T.StringType()),
        T.StructField("reputation", T.LongType()),
        T.StructField("link", T.StringType()),
    ])),
    T.StructField("creation_date", T.LongType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("score", T.LongType()),
    T.StructField("answer_count", T.LongType()),
])

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(PAYLOAD_ITEM_SCHEMA)),
])

QUESTION_FIELDS = QUESTION_SCHEMA.fieldNames()
AUTHOR_FIELDS = AUTHOR_SCHEMA.fieldNames()

# Author name that stands for "nobody known" in every source.
UNKNOWN_AUTHOR = "Unknown"
