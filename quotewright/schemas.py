"""Column lists, schemas and fixed values shared by every zone."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and spelling are part of the data contract.
QUOTE_COLUMNS = (
    "symbol",
    "company_name",
    "exchange",
    "currency",
    "price",
    "open_price",
    "high_price",
    "low_price",
    "previous_close",
    "change",
    "change_percent",
    "volume",
    "market_timestamp",
    "ingestion_timestamp",
    "source",
)
PARTITION_COLUMNS = ("year", "month", "day")
BUSINESS_KEY = ("symbol", "market_timestamp")
RAW_FIELDS = (
    "symbol",
    "name",
    "exchange",
    "currency",
    "close",
    "open",
    "high",
    "low",
    "previous_close",
    "change",
    "percent_change",
    "volume",
    "datetime",
    "status",
    "message",
)
REQUIRED_RAW_FIELDS = ("close", "datetime", "symbol")
SOURCE_NAME = "twelve_data"
DEFAULT_WATCHLIST = ("AAPL", "AMZN", "JPM", "WMT", "XOM")

_DOUBLES = {
    "price",
    "open_price",
    "high_price",
    "low_price",
    "previous_close",
    "change",
    "change_percent",
}
_TIMES = {"market_timestamp", "ingestion_timestamp"}


def _typed(name: str) -> T.DataType:
    if name in _DOUBLES:
        return T.DoubleType()
    if name == "volume":
        return T.LongType()
    if name in _TIMES:
        return T.TimestampNTZType()
    return T.StringType()


def _strings(names) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


RAW = T.StructType(_strings(RAW_FIELDS))

# The standardized zone is scanned as text and typed by the curation job, so
# a value of the wrong type becomes a rejected row and not a lost one.
STANDARDIZED = T.StructType(_strings(QUOTE_COLUMNS))

# Partition columns stay strings ("07", not 7): they are given, not inferred.
CURATED = T.StructType(
    [T.StructField(n, _typed(n)) for n in QUOTE_COLUMNS] + _strings(PARTITION_COLUMNS)
)
VALID_BRANCH, REJECTED_BRANCH = "valid", "rejected"
REJECTED = T.StructType(
    [T.StructField(n, _typed(n)) for n in QUOTE_COLUMNS]
    + _strings(["source_file", "rejection_reason"])
    + [T.StructField("rejected_at", T.TimestampNTZType())]
    + _strings(PARTITION_COLUMNS)
)
# Both branches of a curation run in one table; a valid row has no reason.
BRANCHES = T.StructType([*REJECTED.fields, T.StructField("branch", T.StringType())])
# A table that runs of the curation job write to: their id is its last partition.
RUN_PARTITIONS = (*PARTITION_COLUMNS, "run_id")
CURATED_RUNS = T.StructType([*CURATED.fields, T.StructField("run_id", T.StringType())])
REJECTED_RUNS = T.StructType([*REJECTED.fields, T.StructField("run_id", T.StringType())])
