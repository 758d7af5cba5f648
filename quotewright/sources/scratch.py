"""Tables a job keeps in the shared folder while it runs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder, if there is one, in whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the application ends, for tables that a lazy result reads."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder below the shared one, deleted at the end, also after a failure."""
    path = shared_dir(spark, "scratch", f"{name}-{uuid4().hex}")
    try:
        yield path
    finally:
        discard(spark, path)


def store(rows: DataFrame, path: str) -> DataFrame:
    """Rows written to a folder and read from there, so that nothing works them out again."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
