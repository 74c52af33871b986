"""Table and field profiles."""

import json

import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from ..functions.text import shorten

# Fields looked at by default.
NUMERIC_FIELDS = ["score", "view_count", "answer_count", "question_id"]
DATE_FIELDS = ["created_at", "updated_at", "publication_date", "timestamp"]

# Distinct fields that a task holds before it passes them on.
MOST_FIELDS = 100_000


def _field_rows(df, fields, kind):
    present = [f for f in fields if f in df.columns]
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).try_cast(kind).alias("value")) for f in present])
    return df.select(F.inline(rows)).where(F.col("value").isNotNull()) if present else None


def numeric_profile(df: DataFrame, fields=NUMERIC_FIELDS) -> DataFrame:
    """(field, min, max, avg) of the fields the table has; values that are no numbers are left out."""
    rows = _field_rows(df, fields, "double")
    if rows is None:
        return df.sparkSession.createDataFrame([], "field string, min double, max double, avg double")
    return rows.groupBy("field").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("avg"))


def date_profile(df: DataFrame, fields=DATE_FIELDS) -> DataFrame:
    """(field, oldest, newest) as minute texts, of the fields the table has."""
    rows = _field_rows(df, fields, "timestamp")
    if rows is None:
        return df.sparkSession.createDataFrame([], "field string, oldest string, newest string")
    minute = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    return rows.groupBy("field").agg(
        minute(F.min("value")).alias("oldest"), minute(F.max("value")).alias("newest"))


def size_profile(df: DataFrame) -> DataFrame:
    """Rows, megabytes and mean bytes of the rows as JSON text (a stand-in for stored size)."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.select(size.alias("size")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("size") / (1024 * 1024), F.lit(0.0)).alias("total_mb"),
        F.coalesce(F.avg("size"), F.lit(0.0)).alias("avg_bytes"))


class _Unreadable(ValueError):
    pass


def _refuse(name):
    raise _Unreadable(name)


def _fields_once(pairs):
    fields = dict(pairs)
    if len(fields) < len(pairs):
        raise _Unreadable("a field occurs twice")
    return fields


def _type_name(value):
    """the type name of a JSON value; whole numbers beyond 64 bits are floats."""
    if isinstance(value, int) and not isinstance(value, bool) and not -(1 << 63) <= value < 1 << 63:
        return "float"
    if isinstance(value, list):
        return f"Array[{type(value[0]).__name__ if value and isinstance(value[0], list) else _type_name(value[0]) if value else 'empty'}]"
    return type(value).__name__


def json_leaves(text, skip=()):
    """(path, type, example) of every value of a JSON document that is no object; one entry without a path if it cannot be read."""
    try:
        open_values = [(None, json.loads(text, parse_constant=_refuse, object_pairs_hook=_fields_once))]
    except (ValueError, RecursionError):
        yield "", "unreadable", text
        return
    while open_values:
        path, value = open_values.pop()
        if isinstance(value, dict):
            open_values.extend((k if path is None else f"{path}.{k}", v) for k, v in value.items() if k not in skip)
        else:
            example = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
            yield path, _type_name(value), example if not isinstance(value, str) or len(value) <= 50 else value[:47] + "..."


def schema_profile(df: DataFrame, column, skip=("_id",)) -> DataFrame:
    """(field_path, type, count, example) over JSON documents of any depth, in one pass.

    Every task walks its documents and folds equal fields before they are
    shuffled. The example is the smallest value as text, shortened when it is a
    text. Texts that are no JSON (a field that occurs twice and numbers that
    JSON does not know included) count under an empty path as `unreadable`;
    nulls do not count.
    """
    skip = frozenset(skip)

    def folded(batches):
        found = {}

        def rows():
            keys = list(found)
            columns = [[k[0] for k in keys], [k[1] for k in keys], [found[k][0] for k in keys], [found[k][1] for k in keys]]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["field_path", "type", "count", "example"])

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text is None:
                    continue
                for path, kind, example in json_leaves(text, skip):
                    held = found.get((path, kind))
                    if held is None:
                        found[path, kind] = [1, example]
                    else:
                        held[0] += 1
                        held[1] = min(held[1], example)
            # Documents with ever new field names are passed on as they come.
            if len(found) > MOST_FIELDS:
                yield rows()
                found.clear()
        yield rows()

    leaves = df.select(F.col(column).cast("string").alias("doc")).mapInArrow(
        folded, "field_path string, type string, count long, example string")
    return leaves.groupBy("field_path", "type").agg(
        F.sum("count").alias("count"),
        F.min(F.when(F.col("type") == "unreadable", shorten(F.col("example"))).otherwise(F.col("example"))).alias("example"))


def schema_summary(profile: DataFrame) -> DataFrame:
    """one row per field path; several types give a mixed label."""
    types = F.sort_array(F.collect_set("type"))
    return profile.groupBy("field_path").agg(
        types.alias("types"), F.sum("count").alias("count"), F.min("example").alias("example")
    ).select(
        "field_path",
        F.when(F.size("types") == 1, F.get("types", F.lit(0))).otherwise(
            F.concat(F.lit("Mixte ("), F.array_join("types", ", "), F.lit(")"))).alias("type"),
        "count", "example")


def random_sample(df: DataFrame, n=100, seed=0) -> DataFrame:
    """Up to `n` random rows."""
    return df.orderBy(F.rand(seed)).limit(n)


def table_inventory(tables) -> DataFrame:
    """(table_name, row_count) of a dict of frames."""
    rows = None
    for name, table in tables.items():
        row = table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def duplicate_keys(df: DataFrame, *key) -> DataFrame:
    """Keys that occur more than once; none in a sound table."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)
