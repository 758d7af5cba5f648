"""Helpers the corpus operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quotewright.session import shared_dir

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BATCH = 1000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table; Python tasks get a thousand rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: its lineage ends there.

    A task that is run again later reads the same rows from files that outlive
    any executor. The shuffle files behind them are of no use any more; Spark
    deletes them once the driver has collected what refers to them, and with
    little garbage of its own it would wait long.
    """
    spark = frame.sparkSession
    path = shared_dir(spark, "llm", f"{name}-{uuid4().hex}")
    frame.write.parquet(path)
    sweep(spark)
    return spark.read.schema(frame.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files that nothing refers to; a frame's own stay while a caller holds it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def forget(frame: DataFrame) -> None:
    """Delete the files of a settled frame that nothing will read again."""
    spark = frame.sparkSession
    files = frame.inputFiles()
    if files:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(*columns: str) -> Column:
    """A name for a value that may be null, different from every string's."""
    return F.concat_ws(
        "|",
        *(
            F.when(F.col(name).isNull(), F.lit("n")).otherwise(
                F.concat(F.lit("s"), F.col(name).cast("string"))
            )
            for name in columns
        ),
    )


def map_batches(
    frame: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str
) -> DataFrame:
    """Apply a function to the Arrow batches of each task.

    ``start`` is called once per task and gives the function, which returns the
    columns of ``schema`` as Arrow arrays or Python lists.
    """
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            columns = function(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    column.cast(field.type) if isinstance(column, pa.Array) else pa.array(column, field.type)
                    for field, column in ((field, columns[field.name]) for field in target)
                ],
                schema=target,
            )

    return frame.mapInArrow(run, schema)


def spare_names(frame: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that a frame has not."""
    taken = {name.lower() for name in frame.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out
