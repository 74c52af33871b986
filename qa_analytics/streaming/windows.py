"""Running tag counts by event-time window (ST3)."""

from pyspark.sql import DataFrame, functions as F

from ..operators.writes import latest_per_key


def windowed_tag_counts(questions: DataFrame, width="1 day", lateness=None) -> DataFrame:
    """(window_start, tag, count); with `lateness` state of closed windows is dropped, and so are rows later than that."""
    if lateness is not None:
        questions = questions.withWatermark("publication_date", lateness)
    return (
        questions.select("publication_date", F.explode("tags").alias("tag"))
        .groupBy(F.window("publication_date", width), "tag").agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("window.start").alias("window_start"), "tag", "count")
    )


def stream_tag_windows(source: DataFrame, out, checkpoint, width="1 day", lateness="2 days") -> None:
    """ST3: every trigger writes the windows it changed below `<out>/batch=<n>`."""

    def each_batch(changed, batch_id):
        changed.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{out}/batch={batch_id}")

    query = (
        windowed_tag_counts(source, width, lateness).writeStream.outputMode("update")
        .foreachBatch(each_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def current_tag_windows(spark, out) -> DataFrame:
    """The latest count of each window and tag."""
    changes = spark.read.option("recursiveFileLookup", True).parquet(out)
    keyed = changes.select(F.struct("window_start", "tag").alias("key"), "count", "batch_id")
    return latest_per_key(keyed, "key", "batch_id").select("key.*", "count")
