"""Reports over the curated quotes table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import above, exact_mean, rounded
from ..functions.plans import in_order
from ..functions.times import day_key, whole_units
from ..schemas import PARTITION_COLUMNS, QUOTE_COLUMNS


def quotes_between(quotes: DataFrame, first: date, last: date) -> DataFrame:
    """Quotes of the market dates first to last.

    The condition uses partition columns only, so other days are not read.
    """
    return quotes.filter(day_key().between(f"{first:%Y%m%d}", f"{last:%Y%m%d}"))


def preview(quotes: DataFrame, rows: int = 50) -> DataFrame:
    """The newest quotes, all columns."""
    return (
        quotes.select(*QUOTE_COLUMNS, *PARTITION_COLUMNS)
        .orderBy(F.desc("market_timestamp"), "symbol")
        .limit(rows)
    )


def _newest(quotes: DataFrame, *keys: str) -> DataFrame:
    """The newest quote per key. Only one row per key and task is shuffled."""
    newest = Window.partitionBy(*keys).orderBy(
        F.col("market_timestamp").desc_nulls_last(),
        F.col("ingestion_timestamp").desc_nulls_last(),
    )
    ranked = quotes.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_quotes(quotes: DataFrame) -> DataFrame:
    """The newest quote of each symbol, unordered; operand of the top lists."""
    columns = [n for n in QUOTE_COLUMNS if n != "source"]
    return _newest(quotes.select(*columns), "symbol")


def latest_quote(quotes: DataFrame) -> DataFrame:
    """The newest quote of each symbol, by symbol."""
    return latest_quotes(quotes).orderBy("symbol")


# The result columns of the reports and their order.
_TOP_LIST = (
    "symbol",
    "company_name",
    "exchange",
    "price",
    "change",
    "change_percent",
    "volume",
    "market_timestamp",
)


def gainers(quotes: DataFrame, rows: int = 10) -> DataFrame:
    """Symbols whose newest quote rose most, in percent."""
    rose = latest_quotes(quotes).filter(above(F.col("change_percent"), F.lit(0.0)))
    return rose.select(*_TOP_LIST).orderBy(F.desc("change_percent"), "symbol").limit(rows)


def losers(quotes: DataFrame, rows: int = 10) -> DataFrame:
    """Symbols whose newest quote fell most, in percent."""
    fell = latest_quotes(quotes).filter(F.col("change_percent") < 0)
    return fell.select(*_TOP_LIST).orderBy("change_percent", "symbol").limit(rows)


def top_volume(quotes: DataFrame, rows: int = 10) -> DataFrame:
    """Symbols whose newest quote has the highest volume."""
    columns = [n for n in _TOP_LIST if n != "change"]
    newest = latest_quotes(quotes).select(*columns)
    return newest.orderBy(F.col("volume").desc_nulls_last(), "symbol").limit(rows)


def price_range(quotes: DataFrame) -> DataFrame:
    """High minus low of each quote, absolute and in percent of the low."""
    high, low = F.col("high_price"), F.col("low_price")
    percent = F.try_divide(high - low, low) * 100
    ranges = quotes.filter(high.isNotNull() & low.isNotNull()).select(
        "symbol",
        "company_name",
        "price",
        "high_price",
        "low_price",
        (high - low).alias("price_range"),
        rounded(percent, 2).alias("price_range_percent"),
        "market_timestamp",
    )
    return in_order(
        ranges,
        F.col("price_range_percent").desc_nulls_last(),
        F.desc("market_timestamp"),
        "symbol",
    )


def _market_date() -> Column:
    return F.to_date("market_timestamp").alias("market_date")


def daily_summary(quotes: DataFrame) -> DataFrame:
    """Low, high, mean price, volume and quote count per symbol and day."""
    return (
        quotes.groupBy("symbol", _market_date())
        .agg(
            F.min("low_price").alias("daily_low"),
            F.max("high_price").alias("daily_high"),
            exact_mean(F.col("price")).alias("average_observed_price"),
            F.max("volume").alias("reported_volume"),
            F.count("*").alias("quote_count"),
        )
        .orderBy(F.desc("market_date"), "symbol")
    )


def exchange_summary(quotes: DataFrame) -> DataFrame:
    """Symbols, quotes, mean price and change and total volume per exchange."""
    return (
        quotes.groupBy("exchange")
        .agg(
            F.count_distinct("symbol").alias("symbol_count"),
            F.count("*").alias("quote_count"),
            rounded(exact_mean(F.col("price")), 2).alias("average_stock_price"),
            rounded(exact_mean(F.col("change_percent")), 2).alias("average_change_percent"),
            F.sum("volume").alias("total_reported_volume"),
        )
        .orderBy(F.col("total_reported_volume").desc_nulls_last(), "exchange")
    )


def market_breadth(quotes: DataFrame) -> DataFrame:
    """Per day: how many symbols gained, lost or stood still at their last quote."""
    columns = ("symbol", "market_timestamp", "ingestion_timestamp", "change_percent")
    dated = quotes.select(*columns, _market_date())
    change = F.col("change_percent")

    def symbols(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return (
        _newest(dated, "symbol", "market_date")
        .groupBy("market_date")
        .agg(
            F.count("*").alias("symbol_count"),
            symbols(above(change, F.lit(0.0))).alias("gaining_symbols"),
            symbols(change < 0).alias("losing_symbols"),
            symbols(change == 0).alias("unchanged_symbols"),
            rounded(exact_mean(change), 2).alias("average_change_percent"),
        )
        .orderBy(F.desc("market_date"))
    )


# A day of a symbol with more quotes than this is cut into minutes.
DAY_ROWS = 1_000_000
HOT_DAYS = 100_000


def _frames(rows: DataFrame, span: list[Column], before: int) -> tuple[DataFrame, DataFrame]:
    """Means within spans of rows, and the rows a wider span still needs.

    In a span, all but the first rows have their predecessors at hand. The
    first ones, and the last ones that rows of a later span look back to, are
    needed again; ``_done`` tells which of them have their mean already.
    """
    local = Window.partitionBy("symbol", *span).orderBy(*_IN_TIME)
    framed = rows.withColumns(
        {
            "_mean": F.avg("price").over(local.rowsBetween(-before, 0)),
            "_place": F.row_number().over(local),
            "_last": F.lead(F.lit(1), before).over(local).isNull(),
        }
    )
    full = F.col("_place") > before
    means = framed.filter(full & ~F.col("_done")).select("symbol", *_IN_TIME, "_mean")
    rest = framed.filter(~full | F.col("_last")).withColumn("_done", F.col("_done") | full)
    return means, rest.drop("_mean", "_place", "_last")


_IN_TIME = ("market_timestamp", "ingestion_timestamp", "price")


def moving_average(
    quotes: DataFrame,
    observations: int = 7,
    day_rows: int = DAY_ROWS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Mean price over each quote and the ones before it, per symbol.

    A window over a whole symbol would put a symbol with a third of all rows
    into one task. So the frame is taken within a day of a symbol first, and
    only the few rows at the ends of each day go on to the whole symbol. Days
    are counted beforehand: one with too many rows is cut into minutes, whose
    ends meet in the day. There are at most rows / ``day_rows`` such days, so
    they can be broadcast, and a minute is bounded by one quote per
    microsecond. Rows of ``carry`` came before: they count in the means of
    others and get none themselves.
    """
    before = observations - 1
    day = F.date_trunc("day", "market_timestamp")
    rows = quotes.select("symbol", *_IN_TIME, day.alias("_day"), F.lit(False).alias("_done"))
    if carry is not None:
        done = F.lit(True).alias("_done")
        rows = rows.unionByName(carry.select("symbol", *_IN_TIME, day.alias("_day"), done))
    counts = rows.groupBy("symbol", "_day").agg(F.count("*").alias("_rows"))
    total = counts.agg(F.max("_rows").alias("most"), F.sum("_rows").alias("all")).first()
    parts = []
    if (total["most"] or 0) > day_rows:
        limit = max(day_rows, total["all"] // HOT_DAYS)
        hot = counts.filter(F.col("_rows") > limit).select("symbol", "_day", F.lit(True).alias("_hot"))
        rows = rows.join(F.broadcast(hot), ["symbol", "_day"], "left")
        minute = F.date_trunc("minute", "market_timestamp")
        means, rows = _frames(rows, [F.when(F.col("_hot"), minute).otherwise(F.col("_day"))], before)
        parts.append(means)
    means, rows = _frames(rows, [F.col("_day")], before)
    parts.append(means)
    overall = Window.partitionBy("symbol").orderBy(*_IN_TIME).rowsBetween(-before, 0)
    ends = rows.withColumn("_mean", F.avg("price").over(overall)).filter(~F.col("_done"))
    result = ends.select("symbol", *_IN_TIME, "_mean")
    for means in parts:
        result = result.unionByName(means)
    return result


def moving_avg_7(quotes: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """Mean price over seven observations, by symbol and time."""
    means = moving_average(quotes, 7, carry=carry).select(
        "symbol",
        "market_timestamp",
        "price",
        rounded(F.col("_mean"), 2).alias("seven_observation_moving_average"),
    )
    return in_order(means, "symbol", "market_timestamp")


def day_over_day(quotes: DataFrame) -> DataFrame:
    """Change of each day's last price against the last observed day before it.

    The second window holds one row per symbol and day, bounded by the calendar.
    """
    columns = ("symbol", "market_timestamp", "ingestion_timestamp", "price")
    daily = _newest(quotes.select(*columns, _market_date()), "symbol", "market_date")
    by_day = Window.partitionBy("symbol").orderBy("market_date")
    price, previous = F.col("price"), F.col("previous_day_price")
    percent = F.try_divide(price - previous, previous) * 100
    return (
        daily.select("symbol", "market_date", "price")
        .withColumn("previous_day_price", F.lag("price").over(by_day))
        .filter(previous.isNotNull())
        .withColumns(
            {
                "day_over_day_change": price - previous,
                "day_over_day_change_percent": rounded(percent, 2),
            }
        )
        .orderBy(F.desc("market_date"), "symbol")
    )


def volatility(quotes: DataFrame) -> DataFrame:
    """Spread of price and percentage change per symbol and company."""
    price, change = F.col("price"), F.col("change_percent")
    return (
        quotes.groupBy("symbol", "company_name")
        .agg(
            F.count("*").alias("observation_count"),
            rounded(exact_mean(price), 2).alias("average_price"),
            F.round(F.min(price), 2).alias("minimum_price"),
            F.round(F.max(price), 2).alias("maximum_price"),
            rounded(F.stddev_samp(price), 2).alias("price_standard_deviation"),
            rounded(F.stddev_samp(change), 2).alias("change_percent_standard_deviation"),
        )
        .filter(F.col("observation_count") > 1)
        .orderBy(
            F.col("change_percent_standard_deviation").desc_nulls_last(),
            "symbol",
            "company_name",
        )
    )


def freshness(quotes: DataFrame) -> DataFrame:
    """Newest market and ingest time per symbol and the minutes between them."""
    market, ingest = F.col("latest_market_timestamp"), F.col("latest_ingestion_timestamp")
    return (
        quotes.groupBy("symbol")
        .agg(
            F.max("market_timestamp").alias("latest_market_timestamp"),
            F.max("ingestion_timestamp").alias("latest_ingestion_timestamp"),
        )
        .withColumn("market_to_ingestion_delay_minutes", whole_units("MINUTE", market, ingest))
        .orderBy(market.desc_nulls_last(), "symbol")
    )


def partition_summary(quotes: DataFrame, symbols: str = "symbol_count") -> DataFrame:
    """Rows, symbols and time range of each day partition, newest first."""
    return (
        quotes.groupBy(*PARTITION_COLUMNS)
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct("symbol").alias(symbols),
            F.min("market_timestamp").alias("earliest_market_timestamp"),
            F.max("market_timestamp").alias("latest_market_timestamp"),
        )
        .orderBy(*(F.col(n).desc_nulls_last() for n in PARTITION_COLUMNS))
    )
