"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables in a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null stays null.

    ``lower`` has a fast path for ASCII text; other letters must stay as they
    are, so text beyond ASCII goes through ``translate``.
    """
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_key(text_col: str) -> Column:
    """Tells the texts of rows with one id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as ``spark.checkpoint.dir`` names it.

    Only where it is unset and Spark runs in one process, as in tests, is a temporary folder made and set.
    """
    set_by_user = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_by_user:
        return set_by_user.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(current)
        current = spark.sparkContext.getCheckpointDir() or current
    return current.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back.

    This cuts the lineage with files that outlive a lost executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once nothing reads them any more."""
    for df in stored:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_STORE: dict = {}


def worker_store(key: Hashable, make: Callable[[], Any]) -> Any:
    """An object that the tasks of one Python worker share, made when it is first asked for.

    A worker keeps one at a time, so stages that follow each other in it do not add up.
    """
    if key not in _STORE:
        _STORE.clear()
        _STORE[key] = make()
    return _STORE[key]
