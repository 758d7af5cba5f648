"""States of the quality checks for each day partition, which merge by addition.

A key can only repeat across partitions if some row of it lies outside the
partition of its market date. Such stray keys have their own table; all other
repetitions are counted within a day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import date_parts
from ..schemas import BUSINESS_KEY, PARTITION_COLUMNS, QUOTE_COLUMNS
from . import quality

DUPLICATES = ("dq_dup_keys", "dq_dup_rows")

c = F.col


def _at_home() -> Column:
    """The row lies in the partition of its market date."""
    return F.coalesce(~quality.wrong_partition(), F.lit(False)) & c("market_timestamp").isNotNull()


def _zero_if_null(total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast("bigint"))


def _whole_key() -> Column:
    return reduce(lambda a, b: a & b, (c(n).isNotNull() for n in BUSINESS_KEY))


def _repeated(rows: Column) -> Column:
    return F.when(rows > 1, rows).otherwise(0)


def _counters() -> dict[str, Column]:
    nulls = {f"{n}_nulls": c(n).isNull() for n in QUOTE_COLUMNS}
    checks = {name: condition for name, (condition, _) in quality.row_checks().items()}
    return nulls | quality.scorecard_checks() | checks


def check_states(quotes: DataFrame) -> DataFrame:
    """Rows, NULLs, failures of each check and repeated keys of each day partition."""
    counters = _counters()
    sums = quotes.groupBy(*PARTITION_COLUMNS).agg(
        F.count("*").alias("total_rows"),
        *(F.count_if(condition).alias(name) for name, condition in counters.items()),
    )
    counted = quotes.filter(_at_home()).groupBy(*PARTITION_COLUMNS, *BUSINESS_KEY).count()
    rows = _repeated(c("count"))
    repeated = counted.groupBy(*PARTITION_COLUMNS).agg(
        F.count_if(rows > 0).alias("dq_dup_keys"),
        F.sum(F.when(_whole_key(), rows).otherwise(0)).alias("dq_dup_rows"),
    )
    return (
        sums.unionByName(repeated, allowMissingColumns=True)
        .groupBy(*PARTITION_COLUMNS)
        .agg(*(_zero_if_null(F.sum(n)).alias(n) for n in ("total_rows", *counters, *DUPLICATES)))
    )


def stray_keys(quotes: DataFrame) -> DataFrame:
    """The keys of rows outside the partition of their market date, counted by partition."""
    strays = quotes.filter(~_at_home())
    return strays.groupBy(*PARTITION_COLUMNS, *BUSINESS_KEY).agg(F.count("*").alias("row_count"))


def _sums(states: DataFrame, names) -> DataFrame:
    """One row; NULL over no states, as a plain sum is, but no rows are 0 rows."""
    total = _zero_if_null(F.sum("total_rows")).alias("total_rows")
    return states.agg(total, *(F.sum(n).alias(n) for n in names))


def null_profile_of(states: DataFrame) -> DataFrame:
    """The NULL profile of the days whose states are given."""
    return _sums(states, [f"{n}_nulls" for n in QUOTE_COLUMNS])


def scorecard_of(states: DataFrame) -> DataFrame:
    """The scorecard of the days whose states are given."""
    return _sums(states, quality.scorecard_checks())


def _stray_repetitions(strays: DataFrame, quotes: DataFrame) -> DataFrame:
    """What stray keys add to the keys and rows counted at home.

    Rows at home of these keys are looked up in their own partitions; without
    strays, nothing is read.
    """
    keys = strays.groupBy(*BUSINESS_KEY).agg(F.sum("row_count").alias("strays"))
    # A key without a market time has no home.
    homes = keys.filter(c("market_timestamp").isNotNull()).withColumns(
        date_parts(c("market_timestamp"))
    )
    rows = quotes.select(*PARTITION_COLUMNS, *BUSINESS_KEY).alias("q")
    same = [c(f"q.{n}") == c(f"k.{n}") for n in (*PARTITION_COLUMNS, "market_timestamp")]
    same.append(c("q.symbol").eqNullSafe(c("k.symbol")))
    found = rows.join(homes.alias("k"), same, "left_semi")
    at_home = found.groupBy(*BUSINESS_KEY).agg(F.count("*").alias("homes"))
    both = (
        keys.unionByName(at_home, allowMissingColumns=True)
        .groupBy(*BUSINESS_KEY)
        .agg(*(_zero_if_null(F.sum(n)).alias(n) for n in ("strays", "homes")))
    )
    now, before = _repeated(c("strays") + c("homes")), _repeated(c("homes"))
    return both.agg(
        _zero_if_null(F.count_if(now > 0) - F.count_if(before > 0)).alias("dq_dup_keys"),
        _zero_if_null(F.sum(F.when(_whole_key(), now - before))).alias("dq_dup_rows"),
    )


def report_of(states: DataFrame, strays: DataFrame, quotes: DataFrame) -> DataFrame:
    """The report of all checks from states and stray keys of the same days of ``quotes``."""
    checks = {name: expectation for name, (_, expectation) in quality.row_checks().items()}
    totals = states.agg(*(_zero_if_null(F.sum(n)).alias(n) for n in checks))
    parts = states.select(*DUPLICATES).unionByName(_stray_repetitions(strays, quotes))
    duplicates = parts.agg(*(_zero_if_null(F.sum(n)).alias(n) for n in DUPLICATES))
    return quality.long_form(totals, checks).unionByName(
        quality.long_form(duplicates, dict.fromkeys(DUPLICATES, quality.NO_ROWS))
    )
