"""Total orders over unbounded tables: row positions and exact medians.

Positions: rows are sorted with Spark's range partitioning and kept in the
shared folder, and each partition's offset comes from one small row per
partition; no task sees more than its own range. Medians need no sort: a sketch
encloses the middle, and only what it encloses is counted value by value.
"""

from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable

# Shares of the rows that enclose the median, ten times farther apart than a sketch of 1 / SKETCH errs.
BRACKET, SKETCH, SLOTS = (0.499, 0.501), 10_000, 4096


def _sorted_with_slot(df: DataFrame, order) -> DataFrame:
    """The sorted table with its partition and a number that rises inside each."""
    return durable(df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_slot")))


def with_position(df: DataFrame, *order, name="position") -> DataFrame:
    """0-based position of each row in a unique order."""
    placed = _sorted_with_slot(df, order)
    # One row per shuffle partition, hence safe to order in one task and to broadcast.
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first"))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("_part", (before - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_slot") + F.col("_shift")).alias(name))


def batch_numbers(ids: DataFrame, batch_size, key="question_id") -> DataFrame:
    """Consecutive batches of `batch_size` keys, numbered from 1, in key order."""
    placed = with_position(ids.select(key), key)
    return placed.select(key, (F.floor(F.col("position") / batch_size) + 1).alias("batch_no"))


def numeric_summary(df: DataFrame, columns) -> DataFrame:
    """One row per column: count, mean, exact median, min, max, population deviation, zeros.

    A column without any value has a row of zeros.

    A first pass takes all figures but the median, and from a sketch two values
    that enclose it. A second pass counts what lies below them and how often
    each value between them occurs; these counts are dealt to `SLOTS` slots of
    equal width, and only the one or two slots that hold the middle are put in
    order. The sketch bounds the work, not the result. Nothing runs while the
    plan is made and nothing is written.
    """
    def facts(c):
        v = F.col(f"`{c}`").cast("double")
        sketch = F.percentile_approx(v, list(BRACKET), SKETCH)
        few = F.count(v) <= SKETCH
        return F.struct(
            F.lit(c).alias("metric"), F.count(v).alias("total"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.stddev_pop(v).alias("std"), F.count_if(v == 0).alias("zeros"),
            F.when(few, F.min(v)).otherwise(F.get(sketch, F.lit(0))).alias("lo"),
            F.when(few, F.max(v)).otherwise(F.get(sketch, F.lit(1))).alias("hi"))

    known = df.agg(F.array(*map(facts, columns)).alias("all")).select(F.inline("all"))
    pairs = df.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns))))
    # `known` has one row per requested column. Null stands for all values below the enclosed ones.
    near = pairs.join(F.broadcast(known.select("metric", "total", "lo", "hi")), "metric").where("value <= hi")
    counts = near.groupBy("metric", "total", "lo", "hi", F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("value")).agg(
        F.count("*").alias("n"))
    slot = F.floor((F.col("value") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * SLOTS)
    counts = counts.select("metric", "total", "value", "n", F.when(F.col("value").isNull(), -1).otherwise(
        F.least(F.coalesce(slot, F.lit(0)), F.lit(SLOTS - 1))).cast("int").alias("slot"))
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")
    stop = F.sum("n").over(Window.partitionBy("metric").orderBy("slot"))
    slots = counts.groupBy("metric", "total", "slot").agg(F.sum("n").alias("n")).select("metric", "slot", (stop - F.col("n")).alias(
        "start"), stop.alias("stop"), low.alias("low"), high.alias("high"))
    # At most two slots per column hold the middle.
    middle = slots.where("slot >= 0 and start <= high and stop > low").drop("stop")
    upto = F.col("start") + F.sum("n").over(Window.partitionBy("metric", "slot").orderBy("value"))
    ranked = counts.join(F.broadcast(middle), ["metric", "slot"]).select("metric", "value", "low", "high", "n", upto.alias("upto"))

    def at(rank):
        return F.max(F.when((F.col("upto") - F.col("n") <= F.col(rank)) & (F.col("upto") > F.col(rank)), F.col("value")))

    medians = ranked.groupBy("metric").agg(((at("low") + at("high")) / 2).alias("median"))
    return known.join(F.broadcast(medians), "metric", "left").select("metric", *(
        F.coalesce(c, F.lit(0)).cast("long" if c in ("total", "zeros") else "double").alias(c)
        for c in ("total", "mean", "median", "min", "max", "std", "zeros")))
