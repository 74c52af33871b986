"""Test-run log files."""

from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip

# Outcome markers of the log lines.
MARKERS = {"passed": "✅ RÉUSSI: ", "failed": "❌ ÉCHEC: ", "error": "🚫 ERREUR: ", "skipped": "⏭️  IGNORÉ: "}
DURATION = r"Durée totale: ([0-9.]+) secondes"

LOG_KINDS = ("run", "errors", "summary")


def read_log_lines(spark, path) -> DataFrame:
    """Lines of one or more log files."""
    return spark.read.text(path).select("value")


def newest_of_kind(files: DataFrame) -> DataFrame:
    """S12 on a listing (path, modificationTime): the newest file of each kind, the last path on ties; other names are ignored."""
    kind = F.regexp_extract("path", r"(?:^|/)test_([a-z]+)_[^/]*\.log$", 1)
    return (
        files.select("path", "modificationTime", kind.alias("kind"))
        .where(F.col("kind").isin(list(LOG_KINDS)))
        .groupBy("kind").agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
    )


def newest_logs(spark, folder) -> DataFrame:
    """The newest log file of each kind in a folder; file contents are not read."""
    return newest_of_kind(spark.read.format("binaryFile").option("pathGlobFilter", "test_*_*.log").load(folder))


def log_outcomes(lines: DataFrame, column="value") -> DataFrame:
    """(outcome, name, duration) of each outcome line.

    The name ends at the first parenthesis, except for skipped tests; a line
    without seconds has duration 0.
    """
    line, outcome, rest = F.col(column), F, F
    for label, marker in MARKERS.items():
        hit = F.contains(line, F.lit(marker))
        outcome = outcome.when(hit, label)
        rest = rest.when(hit, F.substr(line, F.locate(marker, line) + len(marker)))
    marked = lines.select(outcome.alias("outcome"), rest.alias("rest")).where(F.col("outcome").isNotNull())
    skipped, text = F.col("outcome") == "skipped", F.col("rest")
    seconds = F.regexp_extract(text, r"^[^(]+\(([0-9.]+)s\)", 1).try_cast("double")
    named = marked.where(F.when(skipped, text != "").otherwise(text.rlike(r"^[^(]")))
    return named.select(
        "outcome", strip(F.when(skipped, text).otherwise(F.substring_index(text, "(", 1))).alias("name"),
        F.coalesce(F.when(~skipped, seconds), F.lit(0.0)).alias("duration"))


def log_duration(lines: DataFrame, column="value") -> DataFrame:
    """one row with the total duration a log states, 0 without the line (the largest of several)."""
    stated = F.regexp_extract(F.col(column), DURATION, 1).try_cast("double")
    return lines.where(F.contains(F.col(column), F.lit("Durée totale"))).agg(F.coalesce(F.max(stated), F.lit(0.0)).alias("total_duration"))
