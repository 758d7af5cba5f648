"""Rows for the tests."""

from __future__ import annotations

import json
from datetime import datetime

from quotewright.schemas import CURATED, QUOTE_COLUMNS, STANDARDIZED

RUN_TIME = datetime(2025, 3, 5, 14, 20, 5)

RESPONSE = {
    "symbol": "nqra",
    "name": "Norquay Ranges",
    "exchange": "NASDAQ",
    "currency": "USD",
    "close": "64.25",
    "open": "63.50",
    "high": "66.40",
    "low": "61.80",
    "previous_close": "63.75",
    "change": "0.50",
    "percent_change": "0.7843",
    "volume": "731204",
    "datetime": "2025-03-04",
}

STANDARD = {
    "symbol": "NQRA",
    "company_name": "Norquay Ranges",
    "exchange": "NASDAQ",
    "currency": "USD",
    "price": "64.25",
    "open_price": "63.50",
    "high_price": "66.40",
    "low_price": "61.80",
    "previous_close": "63.75",
    "change": "0.50",
    "change_percent": "0.7843",
    "volume": "731204",
    "market_timestamp": "2025-03-04",
    "ingestion_timestamp": "2025-03-04T15:30:00+00:00",
    "source": "twelve_data",
}


def response(drop=(), **changes) -> str:
    fields = {**RESPONSE, **changes}
    return json.dumps({k: v for k, v in fields.items() if k not in drop}, ensure_ascii=False)


def responses(spark, *texts):
    """Responses of one run, in order; a pair gives the requested symbol too."""
    rows = []
    for i, item in enumerate(texts):
        symbol, text = item if isinstance(item, tuple) else ("NQRA", item)
        rows.append((RUN_TIME, i, symbol, text))
    schema = (
        "run_timestamp timestamp_ntz, position bigint, requested_symbol string, response string"
    )
    return spark.createDataFrame(rows, schema)


def standardized(spark, *changes):
    rows = [tuple({**STANDARD, **change}[n] for n in QUOTE_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, STANDARDIZED)


def quote(symbol="NQRA", at="2025-03-04 10:00:00", **changes) -> tuple:
    """A curated row."""
    moment = datetime.fromisoformat(at) if isinstance(at, str) else at
    row = {
        "symbol": symbol,
        "company_name": f"{symbol} Company",
        "exchange": "NASDAQ",
        "currency": "USD",
        "price": 41.0,
        "open_price": 40.5,
        "high_price": 43.0,
        "low_price": 39.0,
        "previous_close": 40.0,
        "change": 1.0,
        "change_percent": 2.5,
        "volume": 1000,
        "market_timestamp": moment,
        "ingestion_timestamp": moment,
        "source": "twelve_data",
        "year": f"{moment:%Y}" if moment else None,
        "month": f"{moment:%m}" if moment else None,
        "day": f"{moment:%d}" if moment else None,
        **changes,
    }
    return tuple(row[f.name] for f in CURATED)


def quotes(spark, *rows):
    return spark.createDataFrame(list(rows), CURATED)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
