"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset and Spark is one process, as in tests."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialise(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back, so its lineage ends there."""
    path = f"{shared_dir(frame.sparkSession)}/step-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    stored = frame.sparkSession.read.schema(frame.schema).parquet(path)
    stored.stored_at = path
    return stored


def spread(frame: DataFrame) -> DataFrame:
    """A frame that no join gathers on the driver: a stored table of few megabytes may hold millions of rows, and Spark goes by its files."""
    return frame.hint("merge")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*stored: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once nothing reads them any more."""
    for frame in stored:
        delete(frame.sparkSession, frame.stored_at)
