"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where a session has none, as in tests, a temporary one is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="cut-"))
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """The same rows, written once by ``checkpoint()`` to the shared folder and read from there."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever Spark reads it."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def kept_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes rows as Parquet to the shared folder and reads them again; all of it goes in the end."""
    folder = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"

    def keep(frame: DataFrame) -> DataFrame:
        place = f"{folder}/{uuid.uuid4().hex}"
        frame.write.parquet(place)
        return spark.read.schema(frame.schema).parquet(place)

    try:
        yield keep
    finally:
        remove(spark, folder)
