"""Registration of zone folders as tables and views."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from ..schemas import PARTITION_COLUMNS


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    partitions: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Register a partitioned folder, or find new partitions of a known table."""
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING {file_format} "
            f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'"
        )
    spark.catalog.recoverPartitions(name)


def add_columns(spark: SparkSession, name: str, schema: StructType) -> list[str]:
    """Add the columns a table lacks; columns that went missing are left alone."""
    known = {column.lower() for column in spark.table(name).columns}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({StructType(new).toDDL()})")
    return [f.name for f in new]


# Types that hold every value of a narrower one; files written with that are read as them.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}
_CHANGES = "kind string, name string, detail string"


def _widens(old: DataType, new: DataType) -> bool:
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        whole = new.precision - new.scale >= old.precision - old.scale
        return whole and new.scale >= old.scale
    return new.simpleString() in _WIDER.get(old.simpleString(), ())


def _partition_names(spark: SparkSession, name: str) -> set[str]:
    """The partitions a table has in the catalog, which holds them as a list anyway."""
    return {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _listed(
    spark: SparkSession, path: str, schema: StructType, file_format: str, partitions: Sequence[str]
) -> set[str]:
    """The partitions a folder has: Spark lists it for a table that goes again."""
    probe = f"listing_{uuid4().hex}"
    try:
        register_table(spark, probe, path, schema, file_format, partitions)
        return _partition_names(spark, probe)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {probe}")


def update_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    partitions: Sequence[str] = PARTITION_COLUMNS,
) -> DataFrame:
    """Bring a registered table up to its folder and schema, and tell what changed.

    New partitions and columns are added, and a column's type is widened where
    every value keeps its meaning. What cannot be followed is told and left as
    it is: partitions whose folder is gone stay in the catalog, without rows;
    so do columns the schema lacks, and types that changed otherwise. A second
    run therefore changes nothing and tells only what was left. A widened table
    is registered anew over its files, without partitions that were gone.

    One row for each difference: ``kind`` (``added_partition``,
    ``vanished_partition``, ``added_column``, ``missing_column``,
    ``widened_column`` or ``changed_column``), ``name`` and, of types,
    ``detail`` (old and new). Names of columns differ in more than case.
    """
    if not spark.catalog.tableExists(name):
        columns = [f for f in schema.fields if f.name not in partitions]
        register_table(spark, name, path, schema, file_format, partitions)
        changes = [("added_column", f.name, f.dataType.simpleString()) for f in columns]
        changes += [("added_partition", p, None) for p in _partition_names(spark, name)]
        return spark.createDataFrame(sorted(changes, key=lambda row: row[:2]), _CHANGES)

    before = _partition_names(spark, name)
    listed = _listed(spark, path, schema, file_format, partitions)
    changes = [("added_partition", p, None) for p in listed - before]
    changes += [("vanished_partition", p, None) for p in before - listed]

    known = {f.name.lower(): f for f in spark.table(name).schema.fields}
    given = {f.name.lower(): f for f in schema.fields}
    fields, widened = [], False
    for key, field in known.items():
        old, new = field.dataType, given[key].dataType if key in given else None
        types = f"{old.simpleString()} to {new.simpleString()}" if new else None
        if new is None:
            changes.append(("missing_column", field.name, None))
        elif old != new and key not in partitions and _widens(old, new):
            changes.append(("widened_column", field.name, types))
            field, widened = StructField(field.name, new, field.nullable), True
        elif old != new:
            changes.append(("changed_column", field.name, types))
        fields.append(field)

    if widened:
        # A file table's types cannot be altered. Its definition goes and comes again.
        spark.sql(f"DROP TABLE {name}")
        register_table(spark, name, path, StructType(fields), file_format, partitions)
    else:
        spark.catalog.recoverPartitions(name)
    for column in add_columns(spark, name, schema):
        changes.append(("added_column", column, given[column.lower()].dataType.simpleString()))
    return spark.createDataFrame(sorted(changes, key=lambda row: row[:2]), _CHANGES)


def register_view(quotes: DataFrame, name: str = "curated_quotes") -> None:
    """Make quotes available to ``spark.sql`` under a name."""
    quotes.createOrReplaceTempView(name)
