"""Responses to standardized quotes: cases by hand."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quotewright.operators import standardize as st
from quotewright.schemas import QUOTE_COLUMNS
from quotewright.sources.sample_tables import responses_from_events
from tests.builders import RESPONSE, RUN_TIME, response, responses


def classified(spark, text):
    row = st.classify_responses(responses(spark, text)).first()
    return row["status"], row["detail"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (response(), ("OK", None)),
        ('{"symbol": "NQRA", "close": "1", "datetime": "2025-03-04"}', ("OK", None)),
        ('{"status": "error", "message": "API limit reached"}', ("API_ERROR", "API limit reached")),
        ('{"status": "error"}', ("API_ERROR", "Unknown Twelve Data API error.")),
        ('{"status": "error", "message": null}', ("API_ERROR", "None")),
        ('{"symbol": "NQRA"}', ("MISSING_FIELDS", "close, datetime")),
        ("{}", ("MISSING_FIELDS", "close, datetime, symbol")),
        ('{"symbol": null, "close": null, "datetime": null}', ("OK", None)),
        ("not json", ("INVALID_JSON", None)),
        ("", ("INVALID_JSON", None)),
        ("[1]", ("INVALID_JSON", None)),
        ('{"symbol": "A"', ("INVALID_JSON", None)),
        ('{"symbol": "A"} tail', ("INVALID_JSON", None)),
        ('{"symbol": "A"},{"symbol": "B"}', ("INVALID_JSON", None)),
        (None, ("NO_RESPONSE", None)),
    ],
)
def test_classification(spark, text, expected):
    assert classified(spark, text) == expected


def standard(spark, text):
    return st.standardize_quotes(st.classify_responses(responses(spark, text))).first()


def test_full_response_is_parsed(spark):
    row = standard(spark, response())
    assert row["status"] == "OK"
    assert [row[n] for n in QUOTE_COLUMNS] == [
        "NQRA",
        "Norquay Ranges",
        "NASDAQ",
        "USD",
        64.25,
        63.50,
        66.40,
        61.80,
        63.75,
        0.50,
        0.7843,
        731_204,
        "2025-03-04",
        "2025-03-05T14:20:05.000000+00:00",
        "twelve_data",
    ]


def test_absent_texts_get_defaults(spark):
    row = standard(spark, response(drop=("name", "exchange", "currency")))
    assert (row["company_name"], row["exchange"], row["currency"]) == ("", "", "USD")


def test_null_texts_become_the_word_none(spark):
    row = standard(spark, response(symbol=None, name=None, currency=None))
    assert (row["symbol"], row["company_name"], row["currency"]) == ("NONE", "None", "None")


def test_white_space_is_stripped_and_exchange_keeps_its_case(spark):
    row = standard(spark, response(symbol="\t nqra\n", name="\u00a0Café ", exchange=" Nasdaq "))
    assert (row["symbol"], row["company_name"], row["exchange"]) == ("NQRA", "Café", "Nasdaq")


@pytest.mark.parametrize(
    ("volume", "expected"),
    [("1.9", 1), ("-1.9", -1), ("1e6", 1_000_000), (" 5 ", 5), (7, 7), ("1_000", 1000)],
)
def test_volume_is_cut_toward_zero(spark, volume, expected):
    assert standard(spark, response(volume=volume))["volume"] == expected


@pytest.mark.parametrize("volume", ["NaN", "Infinity", "-inf", "n/a", "", None, "1e30"])
def test_unusable_volume_is_invalid(spark, volume):
    assert standard(spark, response(volume=volume))["status"] == "INVALID_RESPONSE"


@pytest.mark.parametrize("close", ["1.5d", "1.5f", "0x10", "abc", "", None, "1__0", "_1", "1,5"])
def test_texts_that_are_no_float_are_invalid(spark, close):
    assert standard(spark, response(close=close))["status"] == "INVALID_RESPONSE"


@pytest.mark.parametrize(
    ("close", "expected"),
    [("1.", 1.0), (".5", 0.5), ("+2", 2.0), ("-3e-2", -0.03), ("1_0.5", 10.5), ("inf", float("inf"))],
)
def test_texts_that_are_floats(spark, close, expected):
    assert standard(spark, response(close=close))["price"] == expected


@pytest.mark.parametrize("field", [k for k in RESPONSE if k not in ("name", "exchange", "currency")])
def test_each_required_field(spark, field):
    row = standard(spark, response(drop=(field,)))
    expected = "MISSING_FIELDS" if field in ("symbol", "close", "datetime") else "INVALID_RESPONSE"
    assert row["status"] == expected


def outcome(spark, **changes):
    row = st.ingest(responses(spark, response(**changes))).first()
    return row["status"], row["detail"]


BETWEEN = "price must be between low_price and high_price"
OPEN_BETWEEN = "open_price must be between low_price and high_price"


@pytest.mark.parametrize(
    ("changes", "messages"),
    [
        ({}, []),
        ({"close": "-1"}, ["price must be greater than zero", BETWEEN]),
        ({"volume": "-1"}, ["volume cannot be negative"]),
        (
            {"high": "60.00"},
            ["high_price cannot be lower than low_price", OPEN_BETWEEN, BETWEEN],
        ),
        ({"close": "69.00"}, [BETWEEN]),
        ({"close": "NaN"}, [BETWEEN]),
        ({"low": "NaN"}, [OPEN_BETWEEN, BETWEEN]),
        ({"high": "NaN"}, [OPEN_BETWEEN, BETWEEN]),
        ({"open": "0"}, ["open_price must be greater than zero", OPEN_BETWEEN]),
        ({"low": "0"}, ["low_price must be greater than zero"]),
        ({"previous_close": "-5"}, ["previous_close must be greater than zero"]),
        ({"datetime": "  "}, ["market_timestamp cannot be blank"]),
        ({"close": "61.80"}, []),
        ({"close": "66.40"}, []),
    ],
)
def test_validation_messages(spark, changes, messages):
    expected = ("OK", None)
    if messages:
        expected = ("VALIDATION_FAILED", "Validation failed for NQRA: " + "; ".join(messages))
    assert outcome(spark, **changes) == expected


def test_blank_symbol_is_named_unknown(spark):
    expected = "Validation failed for UNKNOWN: symbol cannot be blank"
    assert outcome(spark, symbol="  ") == ("VALIDATION_FAILED", expected)


MIXED = [
    ("NQRA", response()),
    ("AMZN", '{"status": "error", "message": "API limit reached"}'),
    ("JPM", response(symbol="jpm", close="870")),
    ("WMT", None),
    ("XOM", response(symbol="xom", volume="n/a")),
]


def test_a_failure_stops_no_other_row(spark):
    rows = st.ingest(responses(spark, *MIXED))
    assert [r["status"] for r in rows.orderBy("position").collect()] == [
        "OK",
        "API_ERROR",
        "VALIDATION_FAILED",
        "NO_RESPONSE",
        "INVALID_RESPONSE",
    ]
    raw = st.raw_zone(rows).orderBy("position")
    assert [r["requested_symbol"] for r in raw.collect()] == ["NQRA", "JPM", "XOM"]
    assert [r["symbol"] for r in st.standardized_zone(rows).collect()] == ["NQRA"]


def test_summary_counts_and_failures_keep_request_order(spark):
    rows = st.ingest(responses(spark, *MIXED))
    row = st.ingest_summary(rows).first()
    assert row["run_id"] == "20250305T142005Z"
    assert (row["requested_count"], row["successful_count"], row["failed_count"]) == (5, 1, 4)
    failed = [r["requested_symbol"] for r in st.failed_symbols(rows).collect()]
    assert failed == ["AMZN", "JPM", "WMT", "XOM"]


def test_no_failure_of_a_large_run_is_lost(spark):
    rows = st.ingest(responses(spark, *((f"F{i}", "not json") for i in range(5000))))
    row = st.ingest_summary(rows).first()
    assert (row["requested_count"], row["failed_count"]) == (5000, 5000)
    failed = [r["requested_symbol"] for r in st.failed_symbols(rows).collect()]
    assert failed == [f"F{i}" for i in range(5000)]


def test_jsonl_keeps_nulls_and_other_scripts(spark):
    rows = spark.createDataFrame([("Café 株", None, 1.5)], "a string, b string, c double")
    line = st.to_jsonl(rows).first()[0]
    assert json.loads(line) == {"a": "Café 株", "b": None, "c": 1.5}
    assert "Café 株" in line


def test_symbols_keep_repeats_and_lose_blanks(spark):
    rows = spark.createDataFrame([(" nqra ",), ("",), ("\t",), ("JPM",), ("jpm",)], "symbol string")
    assert [r[0] for r in st.symbol_universe(rows).collect()] == ["NQRA", "JPM", "JPM"]


def test_parsing_is_done_once_per_row(spark):
    from tests.builders import plan_of

    rows = st.ingest(responses(spark, *MIXED)).filter(F.col("status") == "OK")
    plan = plan_of(rows)
    # One for the response and one for keys that the fast reader misses.
    assert plan.count("from_json") == 2


def test_failed_symbols_parse_each_response_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    rows = responses(spark, *MIXED).withColumn("response", seen("response"))
    failed = [r["requested_symbol"] for r in st.failed_symbols(st.ingest(rows)).collect()]
    assert failed == ["AMZN", "JPM", "WMT", "XOM"]
    assert read.value == len(MIXED)


def test_sample_responses_are_compiled(spark, tmp_path):
    rows = [(i, RUN_TIME, i % 7, float(i), '{"k": 3}') for i in (1, 83, 131, 137, 139, 149, 151, 157)]
    schema = "event_id long, ts timestamp_ntz, user_id long, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    found = responses_from_events(spark, str(tmp_path))
    texts = {r["position"]: r["response"] for r in found.collect()}
    assert set(texts) == {row[0] for row in rows}
    assert list(json.loads(texts[1])) == list(RESPONSE)
    assert list(json.loads(texts[137])) == [n for n in RESPONSE if n != "close"]
    assert json.loads(texts[83])["close"] and ',\r\n  "' in texts[83]
    assert json.loads(texts[131])["status"] == "error" and texts[139] == "not json"
    assert json.loads(texts[149])["volume"] == "n/a" and json.loads(texts[157])["symbol"] is None
    code = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "codegen")
    # Longer methods are interpreted by the JVM and never compiled.
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000
