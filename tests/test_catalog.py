"""A registered table follows its folder and schema; what it cannot follow is told."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from quotewright.schemas import CURATED
from quotewright.sources import catalog, files
from quotewright.sources.scratch import discard
from tests.builders import quote, quotes

TABLE = "updated_zone"


@pytest.fixture
def dropped(spark):
    spark.sql(f"DROP TABLE IF EXISTS {TABLE}")
    yield
    spark.sql(f"DROP TABLE IF EXISTS {TABLE}")


def changes(frame):
    return [tuple(row) for row in frame.collect()]


def day(number):
    return f"year=2025/month=03/day={number}"


def days(spark):
    return sorted(r["day"] for r in spark.table(TABLE).select("day").distinct().collect())


def write_days(spark, path, *numbers):
    """Days in place of all the folder had."""
    discard(spark, path)
    rows = (quote(f"S{n}", f"2025-03-{n} 10:00:00") for n in numbers)
    files.write_curated(quotes(spark, *rows), path)


def test_partitions_come_and_go(spark, tmp_path, dropped):
    path = str(tmp_path / "zone")
    write_days(spark, path, "10", "11")
    first = changes(catalog.update_table(spark, TABLE, path, CURATED))
    assert [row for row in first if row[0] == "added_partition"] == [
        ("added_partition", day(n), None) for n in ("10", "11")
    ]
    write_days(spark, path, "11", "12")
    gone = ("vanished_partition", day("10"), None)
    added = ("added_partition", day("12"), None)
    assert changes(catalog.update_table(spark, TABLE, path, CURATED)) == [added, gone]
    assert days(spark) == ["11", "12"]
    assert changes(catalog.update_table(spark, TABLE, path, CURATED)) == [gone]
    # A partition that comes back is none that vanished.
    write_days(spark, path, "10", "11", "12")
    assert changes(catalog.update_table(spark, TABLE, path, CURATED)) == []
    assert days(spark) == ["10", "11", "12"]


def fields(**types):
    return StructType([StructField(name, kind) for name, kind in types.items()])


def test_columns_change(spark, tmp_path, dropped):
    path = str(tmp_path / "zone")
    part = {"part": StringType()}
    old = fields(
        count=IntegerType(), amount=DecimalType(10, 2), on=DateType(), text=StringType(), old=LongType(), **part
    )
    new = fields(
        Count=LongType(),
        amount=DecimalType(12, 3),
        on=TimestampNTZType(),
        text=IntegerType(),
        note=DoubleType(),
        **part,
    )
    rows = spark.range(1).select(
        F.lit(7).alias("count"),
        F.lit("1.25").cast("decimal(10,2)").alias("amount"),
        F.lit("2025-03-04").cast("date").alias("on"),
        F.lit("x").alias("text"),
        F.lit(2).cast("bigint").alias("old"),
    )
    for value in ("it's", "b"):
        rows.withColumn("part", F.lit(value)).write.mode("append").partitionBy("part").parquet(path)
    catalog.update_table(spark, TABLE, path, old, partitions=["part"])
    # The quoted partition loses its folder before the types change.
    discard(spark, path)
    rows.withColumn("part", F.lit("b")).write.partitionBy("part").parquet(path)
    left = [("changed_column", "text", "string to int"), ("missing_column", "old", None)]
    found = changes(catalog.update_table(spark, TABLE, path, new, partitions=["part"]))
    assert found == sorted(
        [
            *left,
            ("added_column", "note", "double"),
            ("widened_column", "amount", "decimal(10,2) to decimal(12,3)"),
            ("widened_column", "count", "int to bigint"),
            ("widened_column", "on", "date to timestamp_ntz"),
            ("vanished_partition", "part=it%27s", None),
        ],
        key=lambda row: row[:2],
    )
    table = spark.table(TABLE)
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    assert (kinds["count"], kinds["amount"], kinds["on"]) == ("bigint", "decimal(12,3)", "timestamp_ntz")
    row = table.first()
    assert (row["count"], str(row["amount"]), str(row["on"])) == (7, "1.250", "2025-03-04 00:00:00")
    assert (row["text"], row["old"], row["note"], row["part"]) == ("x", 2, None, "b")
    assert changes(catalog.update_table(spark, TABLE, path, new, partitions=["part"])) == left


@pytest.mark.parametrize(
    ("old", "new", "safe"),
    [
        (IntegerType(), LongType(), True),
        (LongType(), IntegerType(), False),
        (LongType(), DoubleType(), False),
        (IntegerType(), StringType(), False),
        (DecimalType(10, 2), DecimalType(11, 3), True),
        (DecimalType(10, 2), DecimalType(10, 3), False),
        (DecimalType(10, 2), DoubleType(), False),
    ],
)
def test_what_is_widened(old, new, safe):
    assert catalog._widens(old, new) is safe
