"""Stored tables: reading, versioned snapshots, exports and analysis rows."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import as_timestamp, nan_to_null
from ..operators.filters import newest_first, top_authors
from ..schema import AUTHOR_SCHEMA, STORED_QUESTION_SCHEMA


def read_questions(spark, path) -> DataFrame:
    """The whole question table; no analysis needs its order, so none is made."""
    return spark.read.schema(STORED_QUESTION_SCHEMA).parquet(path)


def read_authors(spark, path) -> DataFrame:
    return spark.read.schema(AUTHOR_SCHEMA).parquet(path)


def write_snapshot(df: DataFrame, folder, version) -> str:
    """Write the next version of a table next to the one being read, never over it."""
    path = f"{folder}/v={int(version)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def result_rows(result: DataFrame, table) -> DataFrame:
    """The rows of a result table as JSON texts (P12: not-a-number is null)."""
    clean = [
        (nan_to_null(F.col(c)) if kind in ("double", "float") else F.col(c)).alias(c) for c, kind in result.dtypes]
    return result.select(F.lit(table).alias("table"), F.to_json(F.struct(*clean)).alias("result"))


def analysis_rows(results, analysis_type, as_of, total_questions, duration) -> DataFrame:
    """Analysis rows with type, date, payload and filled metadata, one per row of each result table.

    `total_questions` is a number or a Column, such as a scalar subquery.
    """
    total = total_questions if isinstance(total_questions, Column) else F.lit(int(total_questions))
    rows = None
    for table, result in results.items():
        row = result_rows(result, table)
        rows = row if rows is None else rows.unionByName(row)
    return rows.select(
        F.lit(analysis_type).alias("analysis_type"), as_timestamp(as_of).alias("analysis_date"),
        "table", "result",
        F.struct(
            total.cast("long").alias("total_questions_analyzed"),
            F.lit(float(duration)).alias("analysis_duration"),
        ).alias("metadata"),
    )


def append_analysis(rows: DataFrame, path) -> None:
    """The analysis table only grows."""
    rows.write.mode("append").parquet(path)


def save_results(results, folder, run_stamp) -> None:
    """Every result table as JSON below a folder of the run."""
    for table, result in results.items():
        result.write.mode("errorifexists").json(f"{folder}/analysis_results_{run_stamp}/{table}")


def export_tables(questions, authors, stats, as_of, max_questions=None, max_authors=None):
    """The row sets of a whole-store export; with limits the newest questions and the most active authors."""
    return {
        "questions": newest_first(questions, max_questions),
        "authors": top_authors(authors, max_authors),
        "stats": stats.withColumn("export_date", as_timestamp(as_of)),
    }


def export_json(tables, folder) -> None:
    """Write the export as JSON."""
    for name, table in tables.items():
        table.write.mode("errorifexists").json(f"{folder}/{name}")
