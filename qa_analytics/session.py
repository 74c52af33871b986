"""Session set-up and tables in the shared folder."""

import contextvars
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


# Paths of the tables that `durable` wrote, since the innermost `released` began.
_written = contextvars.ContextVar("written", default=[])


def get_session(app_name="qa_analytics", master=None, **conf):
    """Session with UTC timestamps and adaptive execution on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The cluster's shared checkpoint folder (`spark.checkpoint.dir`).

    Where a local session names none, as in tests, a folder in the warehouse
    takes its place. On a cluster that could be a folder of the driver's
    machine, so there the setting is demanded.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_qa_steps"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def staging_path(spark, name):
    """A fresh path below the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark).rstrip('/')}/qa-{name}-{uuid.uuid4().hex}"
    files, target = _files(spark, path)
    files.deleteOnExit(target)
    return path


def _files(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark, path):
    files, target = _files(spark, path)
    return files.exists(target)


def remove(spark, path):
    """Delete a folder that no result needs any more."""
    files, target = _files(spark, path)
    files.delete(target, True)


def durable(df: DataFrame, path=None, compression=None) -> DataFrame:
    """Write `df` to the shared folder and go on from the written table.

    Lost executors then cost no recomputation, later steps read only the
    columns they need, and Spark knows the size of the result.
    """
    spark = df.sparkSession
    path = path or staging_path(spark, "step")
    df.write.parquet(path, compression=compression)
    _written.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark, make):
    """The durable results of `make()`, a tuple of frames; the tables that it wrote on the way are deleted.

    Its shuffle files go as well: Spark's cleaner frees them once the JVM has
    collected the plans that own them.
    """
    inner = []
    token = _written.set(inner)
    try:
        frames = make()
    finally:
        _written.reset(token)
    kept = tuple(durable(f) for f in frames)
    del frames
    for path in inner:
        remove(spark, path)
    cleaned(spark)
    return kept


def cleaned(spark):
    """Let go of plans that nothing uses, and with them of their shuffle files."""
    gc.collect()
    spark._jvm.System.gc()
