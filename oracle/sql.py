"""DuckDB SQL for the registered queries, composed of common table expressions.

``_STEPS`` names each step once; ``_with`` writes those a query needs, in
order. Averages and rounding use the same decimal forms as the Spark side.
"""

from __future__ import annotations

COLUMNS = (
    "symbol, company_name, exchange, currency, price, open_price, high_price, low_price, "
    "previous_close, change, change_percent, volume, market_timestamp, ingestion_timestamp, source"
)
_ISO = "%Y-%m-%dT%H:%M:%S.%f"


def _cents(x: str) -> str:
    return f"cast(cast({x} / cast(100 as decimal(5,0)) as decimal(18,2)) as varchar)"


def _mean(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(28,9))) as double) / nullif(count({x}), 0)"


def _round(x: str, places: int) -> str:
    return f"cast(round(cast({x} as decimal(28,9)), {places}) as double)"


# Rounded half up in whole numbers: a division of decimals gives a double here.
_TEN_THOUSANDTHS = "sign(chg) * ((abs(chg) * 2000000 + pc) // (2 * pc))"
_PERCENT = f"cast(cast({_TEN_THOUSANDTHS} / 10000 as decimal(18,4)) as varchar)"

_STEPS: dict[str, str] = {
    # -- quote texts from the events table ---------------------------------
    "base0": """
        SELECT event_id, user_id, ts, cast(props->>'k' as int) AS k,
               cast(round(value * 100) as bigint) AS v, 5000 + user_id * 100 AS pc,
               lpad(cast(user_id % 20 as varchar), 3, '0') AS id3
        FROM events""",
    "base1": "SELECT *, (v % 1000) * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) AS chg FROM base0",
    "base2": "SELECT *, pc + chg AS pr FROM base1",
    "base": "SELECT *, greatest(pr, pc) + k AS hi, least(pr, pc) - k % 7 AS lo FROM base2",
    "std": f"""
        SELECT event_id, ts,
          CASE WHEN event_id % 97 = 0 THEN '   ' WHEN event_id % 89 = 0 THEN ' s' || id3 || ' '
               ELSE 'S' || id3 END AS symbol,
          'Company ' || id3 || ' ' AS company_name,
          CASE user_id % 3 WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NYSE' ELSE ' amex ' END AS exchange,
          CASE WHEN user_id % 5 = 0 THEN 'usd ' ELSE 'USD' END AS currency,
          CASE WHEN event_id % 101 = 0 THEN '-1.00' WHEN event_id % 103 = 0 THEN 'abc'
               ELSE {_cents("pr")} END AS price,
          {_cents("pc")} AS open_price,
          CASE WHEN event_id % 127 = 0 THEN {_cents("(lo - 1)")} ELSE {_cents("hi")} END
            AS high_price,
          {_cents("lo")} AS low_price,
          {_cents("pc")} AS previous_close,
          {_cents("chg")} AS change,
          {_PERCENT} AS change_percent,
          CASE WHEN event_id % 113 = 0 THEN '-5' WHEN event_id % 17 = 0 THEN NULL
               ELSE cast((k + 1) * 10000 as varchar) END AS volume,
          CASE WHEN event_id % 107 = 0 THEN 'not-a-date'
               ELSE strftime(date_trunc('hour', ts), '{_ISO}') END AS market_timestamp,
          CASE WHEN event_id % 109 = 0 THEN 'bad' ELSE strftime(ts, '{_ISO}') END
            AS ingestion_timestamp,
          CASE WHEN event_id % 2 = 0 THEN ' Twelve_Data' ELSE 'twelve_data' END AS source
        FROM base""",
    # -- curation ----------------------------------------------------------
    "typed": """
        SELECT event_id, upper(trim(symbol)) AS symbol, trim(company_name) AS company_name,
          upper(trim(exchange)) AS exchange, upper(trim(currency)) AS currency,
          try_cast(price as double) AS price, try_cast(open_price as double) AS open_price,
          try_cast(high_price as double) AS high_price,
          try_cast(low_price as double) AS low_price,
          try_cast(previous_close as double) AS previous_close,
          try_cast(change as double) AS change,
          try_cast(change_percent as double) AS change_percent,
          try_cast(volume as bigint) AS volume,
          try_cast(market_timestamp as timestamp) AS market_timestamp,
          try_cast(ingestion_timestamp as timestamp) AS ingestion_timestamp,
          lower(trim(source)) AS source
        FROM std""",
    "assessed": """
        SELECT *, CASE
            WHEN symbol IS NULL OR length(symbol) = 0 THEN 'MISSING_SYMBOL'
            WHEN price IS NULL OR price <= 0 THEN 'INVALID_PRICE'
            WHEN market_timestamp IS NULL THEN 'INVALID_MARKET_TIMESTAMP'
            WHEN ingestion_timestamp IS NULL THEN 'INVALID_INGESTION_TIMESTAMP'
            WHEN volume < 0 THEN 'NEGATIVE_VOLUME'
            WHEN high_price < low_price THEN 'HIGH_BELOW_LOW' END AS rejection_reason
        FROM typed""",
    "rejected": f"""
        SELECT {COLUMNS}, 'events' AS source_file, rejection_reason,
          timestamp '2024-02-01 12:00:00' AS rejected_at,
          '2024' AS year, '02' AS month, '01' AS day
        FROM assessed WHERE rejection_reason IS NOT NULL""",
    "valid": f"""
        SELECT {COLUMNS}, strftime(market_timestamp, '%Y') AS year,
          strftime(market_timestamp, '%m') AS month, strftime(market_timestamp, '%d') AS day
        FROM assessed WHERE rejection_reason IS NULL""",
    "curated_quotes": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol, market_timestamp ORDER BY
            ingestion_timestamp DESC, company_name DESC, exchange DESC, currency DESC,
            price DESC, open_price DESC, high_price DESC, low_price DESC,
            previous_close DESC, change DESC, change_percent DESC, volume DESC NULLS LAST,
            source DESC) AS rn
          FROM valid) WHERE rn = 1""",
    # -- quotes with faults for the quality checks -------------------------
    "fault0": """
        SELECT event_id,
          CASE WHEN event_id % 137 = 0 THEN ' ' || lower(symbol) ELSE symbol END AS symbol,
          company_name,
          CASE WHEN event_id % 137 = 0 THEN ' ' || lower(exchange) ELSE exchange END AS exchange,
          CASE WHEN event_id % 137 = 0 THEN ' ' || lower(currency) ELSE currency END AS currency,
          CASE WHEN event_id % 131 = 0 THEN high_price + 1
               WHEN event_id % 191 = 0 THEN 'nan'::double ELSE price END AS price,
          open_price,
          CASE WHEN event_id % 173 = 0 THEN 'nan'::double ELSE high_price END AS high_price,
          CASE WHEN event_id % 179 = 0 THEN 'nan'::double ELSE low_price END AS low_price,
          previous_close,
          CASE WHEN event_id % 163 = 0 THEN change + 0.05::double ELSE change END AS change,
          CASE WHEN event_id % 167 = 0 THEN change_percent + 0.1::double
               WHEN event_id % 181 = 0 THEN 'nan'::double
               ELSE change_percent END AS change_percent,
          volume, market_timestamp,
          CASE WHEN event_id % 139 = 0 THEN market_timestamp - interval 1 day
               WHEN event_id % 149 = 0 THEN ingestion_timestamp + interval 26 hour
               ELSE ingestion_timestamp END AS ingestion_timestamp,
          CASE WHEN event_id % 137 = 0 THEN upper(source) ELSE source END AS source
        FROM typed""",
    "faulty": f"""
        SELECT {COLUMNS}, strftime(market_timestamp, '%Y') AS year,
          CASE WHEN event_id % 157 = 0 THEN '7' ELSE strftime(market_timestamp, '%m') END
            AS month,
          CASE WHEN event_id % 151 = 0 THEN '32' ELSE strftime(market_timestamp, '%d') END
            AS day
        FROM fault0""",
    # -- reports' operands -------------------------------------------------
    "latest": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol
            ORDER BY market_timestamp DESC, ingestion_timestamp DESC) AS rn
          FROM curated_quotes) WHERE rn = 1""",
    "daily_latest": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, cast(market_timestamp as date) AS market_date,
            row_number() OVER (PARTITION BY symbol, cast(market_timestamp as date)
              ORDER BY market_timestamp DESC, ingestion_timestamp DESC) AS rn
          FROM curated_quotes) WHERE rn = 1""",
    # -- raw responses -----------------------------------------------------
    "raw0": f"""
        SELECT time_bucket(interval 6 hour, ts) AS run_timestamp, event_id AS position,
          'S' || id3 AS requested_symbol,
          CASE WHEN event_id % 157 = 0 THEN NULL ELSE 's' || id3 END AS symbol,
          'Company ' || id3 AS name,
          CASE user_id % 3 WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NYSE' ELSE 'AMEX' END AS exchange,
          CASE WHEN event_id % 151 = 0 THEN {_cents("(hi + 100)")} ELSE {_cents("pr")} END
            AS "close",
          {_cents("pc")} AS "open", {_cents("hi")} AS high, {_cents("lo")} AS low,
          {_cents("chg")} AS change, {_PERCENT} AS percent_change,
          CASE WHEN event_id % 149 = 0 THEN 'n/a' ELSE cast((k + 1) * 10000 as varchar) END
            AS volume,
          strftime(date_trunc('hour', ts), '{_ISO}') AS datetime
        FROM base""",
    "raw": """
        SELECT run_timestamp, position, requested_symbol,
          strftime(run_timestamp, '%Y%m%dT%H%M%SZ') AS run_id,
          CASE WHEN position % 131 = 0 THEN '{"status":"error","message":"API limit reached"}'
               WHEN position % 137 = 0 THEN cast(json_object(
                 'symbol', symbol, 'name', name, 'exchange', exchange, 'currency', 'USD',
                 'open', "open", 'high', high, 'low', low, 'previous_close', "open",
                 'change', change, 'percent_change', percent_change, 'volume', volume,
                 'datetime', datetime) as varchar)
               WHEN position % 139 = 0 THEN 'not json'
               WHEN position % 83 = 0
               THEN replace(full_response, ',"', ',' || chr(13) || chr(10) || '  "')
               ELSE full_response END AS response
        FROM (SELECT *, cast(json_object(
                 'symbol', symbol, 'name', name, 'exchange', exchange, 'currency', 'USD',
                 'close', "close", 'open', "open", 'high', high, 'low', low,
                 'previous_close', "open", 'change', change,
                 'percent_change', percent_change, 'volume', volume,
                 'datetime', datetime) as varchar) AS full_response FROM raw0)""",
    "parsed": """
        SELECT *, CASE WHEN json_valid(response) THEN cast(response as json) END AS j,
          CASE WHEN json_valid(response) THEN json_keys(response) END AS keys
        FROM raw""",
    "classified": """
        SELECT *, CASE WHEN j IS NULL THEN 'INVALID_JSON'
            WHEN j->>'status' = 'error' THEN 'API_ERROR'
            WHEN NOT list_has_all(keys, ['close', 'datetime', 'symbol']) THEN 'MISSING_FIELDS'
            ELSE 'OK' END AS first_status,
          CASE WHEN j->>'status' = 'error'
            THEN coalesce(j->>'message', 'Unknown Twelve Data API error.')
            WHEN j IS NOT NULL AND NOT list_has_all(keys, ['close', 'datetime', 'symbol'])
            THEN array_to_string(list_filter(['close', 'datetime', 'symbol'],
                   lambda f: NOT list_contains(keys, f)), ', ') END AS first_detail
        FROM parsed""",
    "fields": """
        SELECT *, upper(trim(coalesce(j->>'symbol', 'None'))) AS symbol,
          trim(CASE WHEN list_contains(keys, 'name') THEN coalesce(j->>'name', 'None')
               ELSE '' END) AS company_name,
          trim(CASE WHEN list_contains(keys, 'exchange') THEN coalesce(j->>'exchange', 'None')
               ELSE '' END) AS exchange,
          trim(CASE WHEN list_contains(keys, 'currency') THEN coalesce(j->>'currency', 'None')
               ELSE 'USD' END) AS currency,
          try_cast(j->>'close' as double) AS price, try_cast(j->>'open' as double) AS open_price,
          try_cast(j->>'high' as double) AS high_price,
          try_cast(j->>'low' as double) AS low_price,
          try_cast(j->>'previous_close' as double) AS previous_close,
          try_cast(j->>'change' as double) AS change,
          try_cast(j->>'percent_change' as double) AS change_percent,
          cast(trunc(try_cast(j->>'volume' as double)) as bigint) AS volume,
          coalesce(j->>'datetime', 'None') AS market_timestamp,
          strftime(run_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingestion_timestamp,
          'twelve_data' AS source
        FROM classified""",
    "usable": """
        SELECT *, CASE WHEN first_status = 'OK' AND (price IS NULL OR open_price IS NULL
              OR high_price IS NULL OR low_price IS NULL OR previous_close IS NULL
              OR change IS NULL OR change_percent IS NULL OR volume IS NULL)
            THEN 'INVALID_RESPONSE' ELSE first_status END AS second_status
        FROM fields""",
    "checked": """
        SELECT *, array_to_string(list_filter([
            CASE WHEN trim(symbol) = '' THEN 'symbol cannot be blank' END,
            CASE WHEN price <= 0 THEN 'price must be greater than zero' END,
            CASE WHEN open_price <= 0 THEN 'open_price must be greater than zero' END,
            CASE WHEN high_price <= 0 THEN 'high_price must be greater than zero' END,
            CASE WHEN low_price <= 0 THEN 'low_price must be greater than zero' END,
            CASE WHEN previous_close <= 0 THEN 'previous_close must be greater than zero' END,
            CASE WHEN volume < 0 THEN 'volume cannot be negative' END,
            CASE WHEN high_price < low_price
              THEN 'high_price cannot be lower than low_price' END,
            CASE WHEN NOT (low_price <= open_price AND open_price <= high_price)
              THEN 'open_price must be between low_price and high_price' END,
            CASE WHEN NOT (low_price <= price AND price <= high_price)
              THEN 'price must be between low_price and high_price' END,
            CASE WHEN trim(market_timestamp) = '' THEN 'market_timestamp cannot be blank' END
          ], lambda m: m IS NOT NULL), '; ') AS errors
        FROM usable""",
    "ingested": """
        SELECT *, CASE WHEN second_status = 'OK' AND errors <> '' THEN 'VALIDATION_FAILED'
            ELSE second_status END AS status,
          CASE WHEN second_status = 'OK' AND errors <> ''
            THEN 'Validation failed for ' || coalesce(nullif(symbol, ''), 'UNKNOWN') || ': '
              || errors ELSE first_detail END AS detail
        FROM checked""",
}

# What each step reads.
_READS = {
    "base1": "base0",
    "base2": "base1",
    "base": "base2",
    "std": "base",
    "typed": "std",
    "assessed": "typed",
    "rejected": "assessed",
    "valid": "assessed",
    "curated_quotes": "valid",
    "fault0": "typed",
    "faulty": "fault0",
    "latest": "curated_quotes",
    "daily_latest": "curated_quotes",
    "raw0": "base",
    "raw": "raw0",
    "parsed": "raw",
    "classified": "parsed",
    "fields": "classified",
    "usable": "fields",
    "checked": "usable",
    "ingested": "checked",
}


def _with(step: str, select: str, extra: dict[str, str] | None = None) -> str:
    """A query over a step, with all steps below it and then the extra ones."""
    chain = [step]
    while chain[-1] in _READS:
        chain.append(_READS[chain[-1]])
    named = {name: _STEPS[name] for name in reversed(chain)} | (extra or {})
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in named.items())
    return f"WITH {ctes}\n{select}"


_TOP = (
    "symbol, company_name, exchange, price, change, change_percent, volume, market_timestamp"
)

# The replayed standardized rows go through curation again.
_REPLAY = {
    "std": f"SELECT position AS event_id, {COLUMNS} FROM ingested WHERE status = 'OK'",
    "typed": _STEPS["typed"].replace("cast(ingestion_timestamp as timestamp)",
                                     "cast(left(ingestion_timestamp, 26) as timestamp)"),
    "assessed": _STEPS["assessed"],
    "valid": _STEPS["valid"],
    "curated_quotes": _STEPS["curated_quotes"],
}

_DELAY = "date_sub('hour', market_timestamp, ingestion_timestamp)"
_GAP = "abs(change - (price - previous_close))"
_CALC_PERCENT = "((change / nullif(previous_close, 0)) * 100)"
_PERCENT_GAP = f"abs(change_percent - {_CALC_PERCENT})"
_WRONG_PARTITION = (
    "(year <> strftime(market_timestamp, '%Y') OR month <> strftime(market_timestamp, '%m') "
    "OR day <> strftime(market_timestamp, '%d'))"
)
_BAD_FORMAT = (
    "(year IS NULL OR month IS NULL OR day IS NULL OR NOT regexp_matches(year, '^[0-9]{4}$') "
    "OR NOT regexp_matches(month, '^(0[1-9]|1[0-2])$') "
    "OR NOT regexp_matches(day, '^(0[1-9]|[12][0-9]|3[01])$'))"
)
_REQUIRED = (
    "(symbol IS NULL OR trim(symbol) = '' OR price IS NULL OR market_timestamp IS NULL "
    "OR ingestion_timestamp IS NULL)"
)


def _less(low: str, high: str) -> str:
    """``low < high`` where NaN compares with nothing."""
    return f"({low} < {high} AND NOT isnan({low}) AND NOT isnan({high}))"


_OUT_OF_RANGE = f"({_less('high_price', 'price')} OR {_less('price', 'low_price')})"
_RANGE = f"(high_price IS NOT NULL AND low_price IS NOT NULL AND {_OUT_OF_RANGE})"
_OHLC = (
    f"(coalesce({_less('high_price', 'open_price')}, false) "
    f"OR coalesce({_less('high_price', 'price')}, false) "
    f"OR coalesce({_less('open_price', 'low_price')}, false) "
    f"OR coalesce({_less('price', 'low_price')}, false))"
)

_ROW_CHECKS = {
    "dq_required": (_REQUIRED, "no_rows"),
    "dq_price": ("price <= 0", "no_rows"),
    "dq_volume": ("volume < 0", "no_rows"),
    "dq_high_low": (_less("high_price", "low_price"), "no_rows"),
    "dq_price_range": (_RANGE, "no_rows"),
    "dq_symbol_norm": ("symbol <> upper(trim(symbol))", "no_rows"),
    "dq_exchange_norm": ("exchange <> upper(trim(exchange))", "no_rows"),
    "dq_currency_norm": ("currency <> upper(trim(currency))", "no_rows"),
    "dq_source_norm": ("source <> lower(trim(source))", "no_rows"),
    "dq_future": ("market_timestamp > ingestion_timestamp", "no_rows"),
    "dq_delay": (f"{_DELAY} > 24", "review"),
    "dq_partition_match": (_WRONG_PARTITION, "no_rows"),
    "dq_partition_format": (_BAD_FORMAT, "no_rows"),
    "dq_change": (_less("0.02::double", _GAP), "no_rows_but_rounding"),
    "dq_change_pct": (_less("0.05::double", _PERCENT_GAP), "no_rows_but_rounding"),
    "dq_ohlc": (_OHLC, "no_rows"),
}


def _report(table: str) -> str:
    parts = [
        f"SELECT '{name}' AS \"check\", count(*) AS failures, '{expected}' AS expectation, "
        f"count(*) = 0 AS passed FROM {table} WHERE {condition}"
        for name, (condition, expected) in _ROW_CHECKS.items()
    ]
    keys = (
        f"(SELECT symbol, market_timestamp, count(*) AS n FROM {table} "
        "GROUP BY 1, 2 HAVING count(*) > 1)"
    )
    parts.append(
        "SELECT 'dq_dup_keys' AS \"check\", count(*) AS failures, 'no_rows' AS expectation, "
        f"count(*) = 0 AS passed FROM {keys}"
    )
    known = "symbol IS NOT NULL AND market_timestamp IS NOT NULL"
    parts.append(
        "SELECT 'dq_dup_rows' AS \"check\", cast(coalesce(sum(n), 0) as bigint) AS failures, "
        "'no_rows' AS expectation, coalesce(sum(n), 0) = 0 AS passed "
        f"FROM {keys} WHERE {known}"
    )
    return "\nUNION ALL ".join(parts)


def _sums(conditions: dict[str, str], table: str) -> str:
    sums = ", ".join(
        f"cast(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) as bigint) AS {name}"
        for name, cond in conditions.items()
    )
    return f"SELECT count(*) AS total_rows, {sums} FROM {table}"


_SCORECARD = {
    "invalid_symbol_rows": "symbol IS NULL OR trim(symbol) = ''",
    "invalid_price_rows": "price IS NULL OR price <= 0",
    "invalid_market_timestamp_rows": "market_timestamp IS NULL",
    "invalid_ingestion_timestamp_rows": "ingestion_timestamp IS NULL",
    "negative_volume_rows": "volume < 0",
    "invalid_high_low_rows": _less("high_price", "low_price"),
    "future_market_timestamp_rows": "market_timestamp > ingestion_timestamp",
    "partition_mismatch_rows": _WRONG_PARTITION,
}
_NULLS = {f"{n}_nulls": f"{n} IS NULL" for n in COLUMNS.split(", ")}


def _partitions(symbols: str, table: str) -> str:
    return (
        f"SELECT year, month, day, count(*) AS row_count, count(DISTINCT symbol) AS {symbols}, "
        "min(market_timestamp) AS earliest_market_timestamp, "
        f"max(market_timestamp) AS latest_market_timestamp FROM {table} GROUP BY 1, 2, 3"
    )


def _volatility(table: str) -> str:
    return f"""SELECT symbol, company_name, count(*) AS observation_count,
              {_round(_mean("price"), 2)} AS average_price,
              round(min(price), 2) AS minimum_price,
              round(max(price), 2) AS maximum_price,
              {_round("stddev_samp(price)", 2)} AS price_standard_deviation,
              {_round("stddev_samp(change_percent)", 2)} AS change_percent_standard_deviation
            FROM {table} GROUP BY 1, 2 HAVING count(*) > 1"""


_SEVEN = f"""SELECT symbol, market_timestamp, price,
      {_round("avg(price) OVER w", 2)} AS seven_observation_moving_average
    FROM curated_quotes
    WINDOW w AS (PARTITION BY symbol ORDER BY market_timestamp
                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


def _exchanges(table: str) -> str:
    return f"""SELECT exchange, count(DISTINCT symbol) AS symbol_count, count(*) AS quote_count,
              {_round(_mean("price"), 2)} AS average_stock_price,
              {_round(_mean("change_percent"), 2)} AS average_change_percent,
              cast(sum(volume) as bigint) AS total_reported_volume
            FROM {table} GROUP BY 1"""


def _curated(select: str) -> str:
    return _with("curated_quotes", select)


def _faulty(select: str) -> str:
    return _with("faulty", select)


_SLOTS = """
    SELECT s.symbol, timezone('UTC', timezone('America/New_York', d.day
             + to_minutes(cast(m.minute as bigint)))) AS slot
    FROM (SELECT symbol, min(cast(ingestion_timestamp as date)) AS first_date,
                 max(cast(ingestion_timestamp as date)) AS last_date
          FROM curated_quotes GROUP BY 1) s,
      (SELECT DISTINCT cast(cast(ingestion_timestamp as date) as timestamp) AS day
       FROM curated_quotes) d,
      LATERAL (SELECT unnest(range(570, 961, 5)) AS minute) m
    WHERE isodow(d.day) < 6 AND d.day BETWEEN s.first_date AND s.last_date"""

_ZONES = """
    SELECT DISTINCT zone, strftime(t, '%Y') AS year, strftime(t, '%m') AS month,
      strftime(t, '%d') AS day
    FROM (SELECT 'raw' AS zone, ts AS t FROM events
          UNION ALL SELECT 'standardized', ts FROM events
          UNION ALL SELECT 'rejected', ts FROM events
          UNION ALL SELECT 'results', ts FROM events
          UNION ALL SELECT 'curated', ts FROM events)"""
_EXPIRED = """
    CASE zone WHEN 'raw' THEN 90 WHEN 'standardized' THEN 365 WHEN 'rejected' THEN 90
      WHEN 'results' THEN 30 END"""

_UNIVERSE = """
    SELECT cast(n_nationkey as bigint) AS position,
      'S' || lpad(cast(n_nationkey * 3 as varchar), 3, '0') AS symbol
    FROM nation WHERE n_nationkey <> 7"""

QUERIES: dict[str, str] = {
    # sources and sinks
    "scan_standardized": _with("std", f"SELECT {COLUMNS} FROM std"),
    "scan_raw": _with("raw", "SELECT run_id, translate(response, chr(13) || chr(10), '  ') AS response FROM raw"),
    "to_jsonl": _with(
        "std",
        "SELECT cast(json_object("
        + ", ".join(f"'{n}', {n}" for n in COLUMNS.split(", "))
        + ") as varchar) AS value FROM std",
    ),
    "run_partitions": _with(
        "raw",
        """SELECT position, strftime(run_timestamp, '%Y') AS year,
             strftime(run_timestamp, '%m') AS month, strftime(run_timestamp, '%d') AS day,
             strftime(run_timestamp, '%H') AS hour, run_id FROM raw""",
    ),
    "curated_roundtrip": _curated(f"SELECT {COLUMNS}, year, month, day FROM curated_quotes"),
    "rejected_roundtrip": _with("rejected", "SELECT * FROM rejected"),
    "symbol_universe": _UNIVERSE,
    "universe_quotes": _with(
        "curated_quotes",
        f"SELECT {COLUMNS} FROM curated_quotes WHERE symbol IN (SELECT symbol FROM universe)",
        {"universe": _UNIVERSE},
    ),
    # raw to standardized
    "classify_responses": _with(
        "classified",
        "SELECT position, first_status AS status, first_detail AS detail FROM classified",
    ),
    "standardize_quotes": _with(
        "usable",
        f"SELECT position, {COLUMNS} FROM usable WHERE second_status = 'OK'",
    ),
    "validate_quotes": _with("ingested", "SELECT position, status, detail FROM ingested"),
    "ingest_split": _with(
        "ingested",
        """SELECT run_id, position, 'standardized' AS zone, symbol, status, detail
           FROM ingested WHERE status = 'OK'
           UNION ALL SELECT run_id, position, 'failed', requested_symbol, status, detail
           FROM ingested WHERE status <> 'OK'""",
    ),
    "ingest_summary": _with(
        "ingested",
        """SELECT run_id, count(*) AS requested_count,
             count(*) FILTER (status = 'OK') AS successful_count,
             count(*) FILTER (status <> 'OK') AS failed_count
           FROM ingested GROUP BY 1""",
    ),
    "failed_symbols": _with(
        "ingested",
        """SELECT run_id, position, requested_symbol, status, detail
           FROM ingested WHERE status <> 'OK' ORDER BY 1, 2""",
    ),
    # curation
    "typed_quotes": _with("typed", f"SELECT {COLUMNS} FROM typed"),
    "rejection_reasons": _with(
        "assessed", "SELECT rejection_reason, count(*) AS row_count FROM assessed GROUP BY 1"
    ),
    "rejected_quotes": _with("rejected", "SELECT * FROM rejected"),
    "curated_quotes": _curated(f"SELECT {COLUMNS}, year, month, day FROM curated_quotes"),
    # reports
    "preview": _curated(
        f"""SELECT {COLUMNS}, year, month, day FROM curated_quotes
            ORDER BY market_timestamp DESC, symbol LIMIT 50"""
    ),
    "latest_quote": _with("latest", f"SELECT {COLUMNS.removesuffix(', source')} FROM latest"),
    "gainers": _with(
        "latest",
        f"""SELECT {_TOP} FROM latest WHERE change_percent > 0
            ORDER BY change_percent DESC, symbol LIMIT 10""",
    ),
    "losers": _with(
        "latest",
        f"""SELECT {_TOP} FROM latest WHERE change_percent < 0
            ORDER BY change_percent, symbol LIMIT 10""",
    ),
    "top_volume": _with(
        "latest",
        f"""SELECT {_TOP.replace(" change,", "")} FROM latest
            ORDER BY volume DESC NULLS LAST, symbol LIMIT 10""",
    ),
    "price_range": _curated(
        f"""SELECT symbol, company_name, price, high_price, low_price,
              high_price - low_price AS price_range,
              {_round("((high_price - low_price) / nullif(low_price, 0)) * 100", 2)}
                AS price_range_percent, market_timestamp
            FROM curated_quotes WHERE high_price IS NOT NULL AND low_price IS NOT NULL"""
    ),
    "daily_summary": _curated(
        f"""SELECT symbol, cast(market_timestamp as date) AS market_date,
              min(low_price) AS daily_low, max(high_price) AS daily_high,
              {_mean("price")} AS average_observed_price,
              max(volume) AS reported_volume, count(*) AS quote_count
            FROM curated_quotes GROUP BY 1, 2"""
    ),
    "exchange_summary": _curated(_exchanges("curated_quotes")),
    "market_breadth": _with(
        "daily_latest",
        f"""SELECT market_date, count(*) AS symbol_count,
              cast(sum(CASE WHEN change_percent > 0 THEN 1 ELSE 0 END) as bigint)
                AS gaining_symbols,
              cast(sum(CASE WHEN change_percent < 0 THEN 1 ELSE 0 END) as bigint)
                AS losing_symbols,
              cast(sum(CASE WHEN change_percent = 0 THEN 1 ELSE 0 END) as bigint)
                AS unchanged_symbols,
              {_round(_mean("change_percent"), 2)} AS average_change_percent
            FROM daily_latest GROUP BY 1""",
    ),
    "moving_avg_7": _curated(_SEVEN),
    "day_over_day": _with(
        "daily_latest",
        f"""SELECT symbol, market_date, price, previous_day_price,
              price - previous_day_price AS day_over_day_change,
              {_round("((price - previous_day_price) / nullif(previous_day_price, 0)) * 100", 2)}
                AS day_over_day_change_percent
            FROM (SELECT symbol, market_date, price, lag(price) OVER (
                    PARTITION BY symbol ORDER BY market_date) AS previous_day_price
                  FROM daily_latest)
            WHERE previous_day_price IS NOT NULL""",
    ),
    "volatility": _curated(_volatility("curated_quotes")),
    "freshness": _curated(
        """SELECT symbol, max(market_timestamp) AS latest_market_timestamp,
             max(ingestion_timestamp) AS latest_ingestion_timestamp,
             date_sub('minute', max(market_timestamp), max(ingestion_timestamp))
               AS market_to_ingestion_delay_minutes
           FROM curated_quotes GROUP BY 1"""
    ),
    "partition_summary": _curated(_partitions("symbol_count", "curated_quotes")),
    "quotes_between": _curated(
        f"""SELECT {COLUMNS}, year, month, day FROM curated_quotes
            WHERE cast(market_timestamp as date) BETWEEN date '2024-01-08' AND date '2024-01-19'
        """
    ),
    # quality checks
    "dq_required": _faulty(
        "SELECT symbol, price, market_timestamp, ingestion_timestamp FROM faulty "
        f"WHERE {_REQUIRED}"
    ),
    "dq_price": _faulty("SELECT symbol, price, market_timestamp FROM faulty WHERE price <= 0"),
    "dq_volume": _faulty("SELECT symbol, volume, market_timestamp FROM faulty WHERE volume < 0"),
    "dq_high_low": _faulty(
        "SELECT symbol, high_price, low_price, market_timestamp FROM faulty "
        f"WHERE {_less('high_price', 'low_price')}"
    ),
    "dq_price_range": _faulty(
        "SELECT symbol, price, high_price, low_price, market_timestamp FROM faulty "
        f"WHERE {_RANGE}"
    ),
    "dq_dup_keys": _with(
        "valid",
        """SELECT symbol, market_timestamp, count(*) AS duplicate_count FROM valid
           GROUP BY 1, 2 HAVING count(*) > 1""",
    ),
    "dq_dup_rows": _with(
        "valid",
        f"""SELECT {COLUMNS}, year, month, day FROM valid
            JOIN (SELECT symbol, market_timestamp FROM valid GROUP BY 1, 2 HAVING count(*) > 1)
              USING (symbol, market_timestamp)""",
    ),
    "dq_symbol_norm": _faulty(
        "SELECT symbol, market_timestamp FROM faulty WHERE symbol <> upper(trim(symbol))"
    ),
    "dq_exchange_norm": _faulty(
        "SELECT symbol, exchange, market_timestamp FROM faulty "
        "WHERE exchange <> upper(trim(exchange))"
    ),
    "dq_currency_norm": _faulty(
        "SELECT symbol, currency, market_timestamp FROM faulty "
        "WHERE currency <> upper(trim(currency))"
    ),
    "dq_source_norm": _faulty(
        "SELECT symbol, source, market_timestamp FROM faulty WHERE source <> lower(trim(source))"
    ),
    "dq_future": _faulty(
        """SELECT symbol, market_timestamp, ingestion_timestamp,
             date_sub('minute', ingestion_timestamp, market_timestamp) AS market_ahead_minutes
           FROM faulty WHERE market_timestamp > ingestion_timestamp"""
    ),
    "dq_delay": _faulty(
        f"""SELECT symbol, market_timestamp, ingestion_timestamp,
              {_DELAY} AS ingestion_delay_hours FROM faulty WHERE {_DELAY} > 24"""
    ),
    "dq_partition_match": _faulty(
        "SELECT symbol, market_timestamp, year, month, day FROM faulty "
        f"WHERE {_WRONG_PARTITION}"
    ),
    "dq_partition_format": _faulty(
        f"SELECT symbol, year, month, day, market_timestamp FROM faulty WHERE {_BAD_FORMAT}"
    ),
    "dq_change": _faulty(
        f"""SELECT symbol, price, previous_close, change,
              price - previous_close AS calculated_change, {_GAP} AS difference, market_timestamp
            FROM faulty WHERE {_less('0.02::double', _GAP)}"""
    ),
    "dq_change_pct": _faulty(
        f"""SELECT symbol, previous_close, change, change_percent,
              {_round(_CALC_PERCENT, 4)} AS calculated_change_percent,
              {_PERCENT_GAP} AS difference, market_timestamp
            FROM faulty WHERE {_less('0.05::double', _PERCENT_GAP)}"""
    ),
    "dq_ohlc": _faulty(
        "SELECT symbol, open_price, high_price, low_price, price, market_timestamp FROM faulty "
        f"WHERE {_OHLC}"
    ),
    "dq_partition_counts": _faulty(_partitions("distinct_symbol_count", "faulty")),
    "dq_symbol_counts": _faulty(
        """SELECT symbol, company_name, count(*) AS record_count,
             min(market_timestamp) AS earliest_market_timestamp,
             max(market_timestamp) AS latest_market_timestamp FROM faulty GROUP BY 1, 2"""
    ),
    "dq_null_profile": _faulty(_sums(_NULLS, "faulty")),
    "dq_scorecard": _faulty(_sums(_SCORECARD, "faulty")),
    "dq_report": _faulty(_report("faulty")),
    "dq_report_curated": _curated(_report("curated_quotes")),
    # operations
    "incremental_curated": _curated(f"SELECT {COLUMNS}, year, month, day FROM curated_quotes"),
    "incremental_open": _curated(f"SELECT {COLUMNS}, year, month, day FROM curated_quotes"),
    "split_rejected": _with("rejected", "SELECT * FROM rejected"),
    "replay_from_raw": _with(
        "ingested", f"SELECT {COLUMNS}, year, month, day FROM curated_quotes", _REPLAY
    ),
    "missing_slots": _with(
        "curated_quotes",
        """SELECT symbol, slot FROM expected
           WHERE (symbol, slot) NOT IN (SELECT symbol,
             time_bucket(interval 5 minute, ingestion_timestamp) FROM curated_quotes)""",
        {"expected": _SLOTS},
    ),
    "health_windows": """
        SELECT window_start, window_start + interval 5 minute AS window_end, errors, throttles,
          max_duration_ms, errors >= 1 AS error_alarm, throttles >= 1 AS throttle_alarm,
          max_duration_ms >= 25000 AS duration_alarm
        FROM (SELECT time_bucket(interval 5 minute, ts) AS window_start,
                count(*) FILTER (event_type = 'error') AS errors,
                count(*) FILTER (event_type = 'signup') AS throttles,
                max(value * 100) AS max_duration_ms
              FROM events GROUP BY 1)""",
    "expired_partitions": f"""
        SELECT zone, year, month, day FROM ({_ZONES})
        WHERE cast(year || '-' || month || '-' || day as date) < date '2024-04-15' - {_EXPIRED}
    """,
    "kept_partitions": f"""
        SELECT zone, year, month, day FROM ({_ZONES})
        WHERE coalesce(cast(year || '-' || month || '-' || day as date)
          >= date '2024-04-15' - {_EXPIRED}, true)
    """,
    "rejected_report": _with(
        "rejected",
        """SELECT rejection_reason, cast(rejected_at as date) AS rejection_date, symbol,
             count(*) AS rejected_count FROM rejected GROUP BY 1, 2, 3""",
    ),
}

# What is merged from rollups by day is what the reports give over all quotes.
_IN_DATES = """WHERE cast(market_timestamp as date)
    BETWEEN date '2024-01-08' AND date '2024-01-19'"""
_BETWEEN = f"(SELECT * FROM curated_quotes {_IN_DATES})"
QUERIES |= {
    "rollup_volatility": QUERIES["volatility"],
    "rollup_volatility_between": _curated(_volatility(_BETWEEN)),
    "rollup_latest_quote": QUERIES["latest_quote"],
    "rollup_market_breadth": QUERIES["market_breadth"],
    "rollup_day_over_day": QUERIES["day_over_day"],
    "rollup_freshness": QUERIES["freshness"],
    "rollup_null_profile": QUERIES["dq_null_profile"],
    "rollup_scorecard": QUERIES["dq_scorecard"],
    "rollup_report": QUERIES["dq_report"],
    "rollup_exchange_summary": QUERIES["exchange_summary"],
    "rollup_exchange_summary_between": _curated(_exchanges(_BETWEEN)),
    "rollup_partition_summary": QUERIES["partition_summary"],
    "rollup_moving_avg_between": _curated(
        f"SELECT * FROM ({_SEVEN}) {_IN_DATES}"
    ),
    "catalog_changes": _curated(
        """SELECT DISTINCT CASE WHEN day > '20' THEN 'added_partition'
             ELSE 'vanished_partition' END AS kind,
             'year=' || year || '/month=' || month || '/day=' || day AS name
           FROM curated_quotes WHERE day > '20' OR day < '10'
           UNION ALL SELECT 'added_column', 'source'"""
    ),
    # Windows and late rows together are the input, whatever order it came in.
    "health_windows_late": QUERIES["health_windows"],
}
