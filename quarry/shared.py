"""The folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Where the session names none; only on one machine.
LOCAL = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Off local mode it must be set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or LOCAL).rstrip("/")


def removed(spark: SparkSession, folder: str, now: bool = True) -> None:
    """Delete a folder of the shared store, now or when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if now:
        store.delete(path, True)
    else:
        store.deleteOnExit(path)
