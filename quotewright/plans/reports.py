"""All reports and checks by name, and their results as files."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from ..operators import analytics, quality
from ..sources.files import write_result

Report = Callable[[DataFrame], DataFrame]

REPORTS: dict[str, Report] = {
    "preview": analytics.preview,
    "latest_quote": analytics.latest_quote,
    "gainers": analytics.gainers,
    "losers": analytics.losers,
    "top_volume": analytics.top_volume,
    "price_range": analytics.price_range,
    "daily_summary": analytics.daily_summary,
    "exchange_summary": analytics.exchange_summary,
    "market_breadth": analytics.market_breadth,
    "moving_avg_7": analytics.moving_avg_7,
    "day_over_day": analytics.day_over_day,
    "volatility": analytics.volatility,
    "freshness": analytics.freshness,
    "partition_summary": analytics.partition_summary,
}

CHECKS: dict[str, Report] = {
    "dq_required": quality.required,
    "dq_price": quality.price,
    "dq_volume": quality.volume,
    "dq_high_low": quality.high_low,
    "dq_price_range": quality.price_in_range,
    "dq_dup_keys": quality.duplicate_keys,
    "dq_dup_rows": quality.duplicate_rows,
    "dq_symbol_norm": quality.symbol_normalized,
    "dq_exchange_norm": quality.exchange_normalized,
    "dq_currency_norm": quality.currency_normalized,
    "dq_source_norm": quality.source_normalized,
    "dq_future": quality.market_ahead,
    "dq_delay": quality.ingest_delay,
    "dq_partition_match": quality.partition_match,
    "dq_partition_format": quality.partition_format,
    "dq_change": quality.change_consistent,
    "dq_change_pct": quality.percent_consistent,
    "dq_ohlc": quality.ohlc,
    "dq_partition_counts": quality.partition_counts,
    "dq_symbol_counts": quality.symbol_counts,
    "dq_null_profile": quality.null_profile,
    "dq_scorecard": quality.scorecard,
    "dq_report": quality.report,
}


def write_reports(
    quotes: DataFrame, path: str, names: Iterable[str] = (*REPORTS, *CHECKS)
) -> dict[str, str]:
    """Write the named results as CSV, a folder each; gives the folders."""
    known = {**REPORTS, **CHECKS}
    folders = {name: f"{path}/{name}" for name in names}
    for name, folder in folders.items():
        write_result(known[name](quotes), folder)
    return folders
