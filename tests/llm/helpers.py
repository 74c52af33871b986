"""Small tables for the text operators."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def docs(spark, rows, **extra):
    """Documents from (doc_id, text[, source]) rows, with extra columns of fixed text."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), *extra.values()) for r in rows]
    schema = T.StructType([*DOCS.fields, *(T.StructField(c, T.StringType()) for c in extra)])
    return spark.createDataFrame(full, schema)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
