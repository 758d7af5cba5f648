"""The reports and checks as Spark SQL over a registered view of curated quotes.

``statement(name, view)`` gives the text; each returns what the function of
the same name in ``plans.reports`` does. NaN compares with nothing in them,
so ``<`` on doubles goes through ``_less``.
"""

from __future__ import annotations

from ..schemas import PARTITION_COLUMNS, QUOTE_COLUMNS

_ALL = ", ".join([*QUOTE_COLUMNS, *PARTITION_COLUMNS])
_TOP = "symbol, company_name, exchange, price, change, change_percent, volume, market_timestamp"
_DAY = "to_date(market_timestamp)"


def _less(low: str, high: str) -> str:
    return f"({low} < {high} AND NOT isnan({low}) AND NOT isnan({high}))"


def _rounded(value: str, places: int) -> str:
    exact = f"cast(round(try_cast({value} AS decimal(28,9)), {places}) AS double)"
    return f"coalesce({exact}, {value})"


def _mean(value: str) -> str:
    """A mean that does not depend on the order of its sum, where decimals hold the values."""
    decimal = f"try_cast({value} AS decimal(28,9))"
    same = f"abs(cast({decimal} AS double) - {value}) <= abs({value}) * {2.0**-51!r}D"
    exact = f"CASE WHEN {same} THEN {decimal} END"
    return (
        f"CASE WHEN count({exact}) = count({value}) "
        f"THEN try_divide(cast(sum({exact}) AS double), count({value})) ELSE avg({value}) END"
    )


def _newest(keys: str, columns: str = "*") -> str:
    """The newest quote per key."""
    return f"""
        SELECT {columns} FROM (
          SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY
            market_timestamp DESC NULLS LAST, ingestion_timestamp DESC NULLS LAST) AS newest
          FROM {{view}}) WHERE newest = 1"""


def _listed(columns: str, condition: str, order: str = "") -> str:
    """The rows that meet a condition."""
    return f"SELECT {columns} FROM {{view}} WHERE {condition}" + (f" ORDER BY {order}" if order else "")


def _partitions(symbols: str) -> str:
    return f"""
        SELECT year, month, day, count(*) AS row_count, count(DISTINCT symbol) AS {symbols},
          min(market_timestamp) AS earliest_market_timestamp,
          max(market_timestamp) AS latest_market_timestamp
        FROM {{view}} GROUP BY year, month, day
        ORDER BY year DESC NULLS LAST, month DESC NULLS LAST, day DESC NULLS LAST"""


_REPORTS = {
    "preview": f"SELECT {_ALL} FROM {{view}} ORDER BY market_timestamp DESC, symbol LIMIT 50",
    "latest_quote": _newest("symbol", ", ".join(n for n in QUOTE_COLUMNS if n != "source")) + " ORDER BY symbol",
    "gainers": f"""
        SELECT {_TOP} FROM ({_newest("symbol")})
        WHERE {_less("0D", "change_percent")} ORDER BY change_percent DESC, symbol LIMIT 10""",
    "losers": f"""
        SELECT {_TOP} FROM ({_newest("symbol")})
        WHERE change_percent < 0 ORDER BY change_percent, symbol LIMIT 10""",
    "top_volume": f"""
        SELECT {_TOP.replace(" change,", "")} FROM ({_newest("symbol")})
        ORDER BY volume DESC NULLS LAST, symbol LIMIT 10""",
    "price_range": f"""
        SELECT symbol, company_name, price, high_price, low_price,
          high_price - low_price AS price_range,
          {_rounded("try_divide(high_price - low_price, low_price) * 100", 2)} AS price_range_percent,
          market_timestamp
        FROM {{view}} WHERE high_price IS NOT NULL AND low_price IS NOT NULL
        ORDER BY price_range_percent DESC NULLS LAST, market_timestamp DESC, symbol""",
    "daily_summary": f"""
        SELECT symbol, {_DAY} AS market_date, min(low_price) AS daily_low, max(high_price) AS daily_high,
          {_mean("price")} AS average_observed_price, max(volume) AS reported_volume,
          count(*) AS quote_count
        FROM {{view}} GROUP BY symbol, {_DAY} ORDER BY market_date DESC, symbol""",
    "exchange_summary": f"""
        SELECT exchange, count(DISTINCT symbol) AS symbol_count, count(*) AS quote_count,
          {_rounded(_mean("price"), 2)} AS average_stock_price,
          {_rounded(_mean("change_percent"), 2)} AS average_change_percent,
          sum(volume) AS total_reported_volume
        FROM {{view}} GROUP BY exchange ORDER BY total_reported_volume DESC NULLS LAST, exchange""",
    "market_breadth": f"""
        SELECT market_date, count(*) AS symbol_count,
          sum(if({_less("0D", "change_percent")}, 1, 0)) AS gaining_symbols,
          sum(if(change_percent < 0, 1, 0)) AS losing_symbols,
          sum(if(change_percent = 0, 1, 0)) AS unchanged_symbols,
          {_rounded(_mean("change_percent"), 2)} AS average_change_percent
        FROM ({_newest(f"symbol, {_DAY}", f"{_DAY} AS market_date, change_percent")})
        GROUP BY market_date ORDER BY market_date DESC""",
    "moving_avg_7": f"""
        SELECT symbol, market_timestamp, price, {_rounded("mean", 2)} AS seven_observation_moving_average
        FROM (SELECT symbol, market_timestamp, price, avg(price) OVER (PARTITION BY symbol
                ORDER BY market_timestamp, ingestion_timestamp, price
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean FROM {{view}})
        ORDER BY symbol, market_timestamp""",
    "day_over_day": f"""
        SELECT symbol, market_date, price, previous_day_price,
          price - previous_day_price AS day_over_day_change,
          {_rounded("try_divide(price - previous_day_price, previous_day_price) * 100", 2)}
            AS day_over_day_change_percent
        FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY market_date) AS previous_day_price
              FROM ({_newest(f"symbol, {_DAY}", f"symbol, {_DAY} AS market_date, price")}))
        WHERE previous_day_price IS NOT NULL ORDER BY market_date DESC, symbol""",
    "volatility": f"""
        SELECT symbol, company_name, count(*) AS observation_count,
          {_rounded(_mean("price"), 2)} AS average_price,
          round(min(price), 2) AS minimum_price, round(max(price), 2) AS maximum_price,
          {_rounded("stddev_samp(price)", 2)} AS price_standard_deviation,
          {_rounded("stddev_samp(change_percent)", 2)} AS change_percent_standard_deviation
        FROM {{view}} GROUP BY symbol, company_name HAVING count(*) > 1
        ORDER BY change_percent_standard_deviation DESC NULLS LAST, symbol, company_name""",
    "freshness": """
        SELECT symbol, max(market_timestamp) AS latest_market_timestamp,
          max(ingestion_timestamp) AS latest_ingestion_timestamp,
          timestampdiff(MINUTE, max(market_timestamp), max(ingestion_timestamp))
            AS market_to_ingestion_delay_minutes
        FROM {view} GROUP BY symbol ORDER BY latest_market_timestamp DESC NULLS LAST, symbol""",
    "partition_summary": _partitions("symbol_count"),
}

_DELAY = "timestampdiff(HOUR, market_timestamp, ingestion_timestamp)"
_CHANGE_GAP = "abs(change - (price - previous_close))"
_PERCENT = "(try_divide(change, previous_close) * 100)"
_PERCENT_GAP = f"abs(change_percent - {_PERCENT})"
_BLANK = "(symbol IS NULL OR trim(symbol) = '')"
_WRONG_DAY = (
    "(year <> date_format(market_timestamp, 'yyyy') OR month <> date_format(market_timestamp, 'MM') "
    "OR day <> date_format(market_timestamp, 'dd'))"
)
_ODD_DAY = (
    "(year IS NULL OR month IS NULL OR day IS NULL OR NOT year RLIKE '^[0-9]{{4}}$' "
    "OR NOT month RLIKE '^(0[1-9]|1[0-2])$' OR NOT day RLIKE '^(0[1-9]|[12][0-9]|3[01])$')"
)
_HIGH_LOW = _less("high_price", "low_price")
_COUNTED = {
    "invalid_symbol_rows": _BLANK,
    "invalid_price_rows": "price IS NULL OR price <= 0",
    "invalid_market_timestamp_rows": "market_timestamp IS NULL",
    "invalid_ingestion_timestamp_rows": "ingestion_timestamp IS NULL",
    "negative_volume_rows": "volume < 0",
    "invalid_high_low_rows": _HIGH_LOW,
    "future_market_timestamp_rows": "market_timestamp > ingestion_timestamp",
    "partition_mismatch_rows": _WRONG_DAY,
}
_NULLS = {f"{name}_nulls": f"{name} IS NULL" for name in QUOTE_COLUMNS}


def _totals(conditions: dict[str, str]) -> str:
    sums = ", ".join(f"sum(if({condition}, 1, 0)) AS {name}" for name, condition in conditions.items())
    return f"SELECT count(*) AS total_rows, {sums} FROM {{view}}"


_DUPLICATES = """
    SELECT symbol, market_timestamp, count(*) AS duplicate_count FROM {view}
    GROUP BY symbol, market_timestamp HAVING count(*) > 1"""

_CHECKS = {
    "dq_required": _listed(
        "symbol, price, market_timestamp, ingestion_timestamp",
        f"{_BLANK} OR price IS NULL OR market_timestamp IS NULL OR ingestion_timestamp IS NULL",
    ),
    "dq_price": _listed("symbol, price, market_timestamp", "price <= 0"),
    "dq_volume": _listed("symbol, volume, market_timestamp", "volume < 0"),
    "dq_high_low": _listed("symbol, high_price, low_price, market_timestamp", _HIGH_LOW),
    "dq_price_range": _listed(
        "symbol, price, high_price, low_price, market_timestamp",
        "high_price IS NOT NULL AND low_price IS NOT NULL "
        f"AND ({_less('high_price', 'price')} OR {_less('price', 'low_price')})",
    ),
    "dq_dup_keys": _DUPLICATES,
    "dq_dup_rows": f"""
        SELECT {_ALL} FROM {{view}} LEFT SEMI JOIN ({_DUPLICATES}) USING (symbol, market_timestamp)
        ORDER BY symbol, market_timestamp, ingestion_timestamp""",
    "dq_symbol_norm": _listed("symbol, market_timestamp", "symbol <> upper(trim(symbol))"),
    "dq_exchange_norm": _listed("symbol, exchange, market_timestamp", "exchange <> upper(trim(exchange))"),
    "dq_currency_norm": _listed("symbol, currency, market_timestamp", "currency <> upper(trim(currency))"),
    "dq_source_norm": _listed("symbol, source, market_timestamp", "source <> lower(trim(source))"),
    "dq_future": _listed(
        "symbol, market_timestamp, ingestion_timestamp, "
        "timestampdiff(MINUTE, ingestion_timestamp, market_timestamp) AS market_ahead_minutes",
        "market_timestamp > ingestion_timestamp",
    ),
    "dq_delay": _listed(
        f"symbol, market_timestamp, ingestion_timestamp, {_DELAY} AS ingestion_delay_hours",
        f"{_DELAY} > 24",
        "ingestion_delay_hours DESC, symbol, market_timestamp, ingestion_timestamp",
    ),
    "dq_partition_match": _listed("symbol, market_timestamp, year, month, day", _WRONG_DAY),
    "dq_partition_format": _listed("symbol, year, month, day, market_timestamp", _ODD_DAY),
    "dq_change": _listed(
        "symbol, price, previous_close, change, price - previous_close AS calculated_change, "
        f"{_CHANGE_GAP} AS difference, market_timestamp",
        _less("0.02D", _CHANGE_GAP),
    ),
    "dq_change_pct": _listed(
        f"symbol, previous_close, change, change_percent, {_rounded(_PERCENT, 4)} AS calculated_change_percent, "
        f"{_PERCENT_GAP} AS difference, market_timestamp",
        _less("0.05D", _PERCENT_GAP),
    ),
    "dq_ohlc": _listed(
        "symbol, open_price, high_price, low_price, price, market_timestamp",
        " OR ".join(
            _less(low, high)
            for low, high in (
                ("high_price", "open_price"),
                ("high_price", "price"),
                ("open_price", "low_price"),
                ("price", "low_price"),
            )
        ),
    ),
    "dq_partition_counts": _partitions("distinct_symbol_count"),
    "dq_symbol_counts": """
        SELECT symbol, company_name, count(*) AS record_count,
          min(market_timestamp) AS earliest_market_timestamp,
          max(market_timestamp) AS latest_market_timestamp
        FROM {view} GROUP BY symbol, company_name ORDER BY record_count DESC, symbol, company_name""",
    "dq_null_profile": _totals(_NULLS),
    "dq_scorecard": _totals(_COUNTED),
}

STATEMENTS = _REPORTS | _CHECKS


def statement(name: str, view: str = "curated_quotes") -> str:
    """The SQL text of a report or check over a view or table."""
    return STATEMENTS[name].format(view=view)
