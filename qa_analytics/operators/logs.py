"""Roll-ups of parsed test logs."""

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import test_flags
from ..functions.values import percent, rate

OUTCOMES = ("passed", "failed", "error", "skipped")


def log_rollup(outcomes: DataFrame, duration: DataFrame, include_errors=True) -> DataFrame:
    """A30, A31, B9, one row.

    `duration` is a one-row (total_duration) frame. With
    `include_errors=False` errors are left out of the total, as a plain text
    report does; extremes look at passed and failed tests.
    """
    kind, seconds = F.col("outcome"), F.col("duration")
    timed = F.when(kind.isin("passed", "failed"), seconds)
    zero = F.lit(0).cast("long")
    counts = outcomes.agg(
        *[F.count_if(kind == o).alias(o) for o in OUTCOMES],
        F.coalesce(F.min(timed), F.lit(0.0)).alias("fastest"),
        F.coalesce(F.max(timed), F.lit(0.0)).alias("slowest"),
        F.lit(0.0).alias("total_duration"),
    )
    stated = duration.select(
        *[zero.alias(o) for o in OUTCOMES], F.lit(0.0).alias("fastest"), F.lit(0.0).alias("slowest"), "total_duration")
    row = counts.unionByName(stated).agg(
        *[F.sum(c).alias(c) for c in (*OUTCOMES, "fastest", "slowest", "total_duration")])
    passed, failed, error, skipped = (F.col(o) for o in OUTCOMES)
    total = passed + failed + skipped + (error if include_errors else F.lit(0))
    return row.withColumn("total", total).withColumns({
        **{f"{o}_rate": percent(F.col(o), F.col("total")) for o in OUTCOMES},
        "tests_per_second": rate(F.col("total"), F.col("total_duration")),
        **test_flags(passed, failed, error, skipped, F.col("total_duration")),
    })


def slowest_tests(outcomes: DataFrame, limit=5, include_errors=True) -> DataFrame:
    """T6."""
    kinds = ["passed", "failed"] + (["error"] if include_errors else [])
    return outcomes.where(F.col("outcome").isin(kinds)).orderBy(F.desc("duration"), "name").limit(limit)
