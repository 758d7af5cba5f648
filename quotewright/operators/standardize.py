"""Raw JSON responses to standardized quotes, as one narrow Spark stage.

Input rows carry ``response`` (the text as received, NULL if none came),
``requested_symbol``, ``position`` (place in the request) and
``run_timestamp``. Nothing raises: every row ends with a ``status``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from ..functions.numbers import below, parse_float, parse_whole, within
from ..functions.plans import in_order, settle
from ..functions.text import strip
from ..functions.times import run_id
from ..schemas import QUOTE_COLUMNS, RAW, REQUIRED_RAW_FIELDS, SOURCE_NAME

OK = "OK"

# Fixed value: the message of an error response that brings none.
DEFAULT_API_MESSAGE = "Unknown Twelve Data API error."

c = F.col


def classify_responses(responses: DataFrame) -> DataFrame:
    """Add ``status``, ``detail``, the parsed ``raw`` struct and its ``keys``.

    The keys tell a field that is absent from one that is present but null.
    The response is parsed as the one element of an array, since text after a
    complete object would otherwise go unnoticed.
    """
    # The required fields stand in order, and the difference keeps it.
    missing = F.array_except(F.array(*map(F.lit, REQUIRED_RAW_FIELDS)), c("keys"))
    alone = F.from_json(F.concat(F.lit("["), "response", F.lit("]")), ArrayType(RAW))
    # The second way also reads the NaN and Infinity literals.
    keys = F.coalesce(
        F.json_object_keys("response"),
        F.map_keys(F.from_json("response", MapType(StringType(), StringType()))),
    )
    parsed = (
        settle(responses, {"_alone": alone, "_keys": keys}, keep=["*"])
        .withColumn("raw", F.when(F.size("_alone") == 1, c("_alone")[0]))
        .withColumn("keys", F.when(c("raw").isNotNull(), c("_keys")))
        .drop("_alone", "_keys")
    )
    is_error = c("raw.status") == "error"
    status = (
        F.when(c("response").isNull(), "NO_RESPONSE")
        .when(c("keys").isNull(), "INVALID_JSON")
        .when(is_error, "API_ERROR")
        .when(F.size(missing) > 0, "MISSING_FIELDS")
        .otherwise(OK)
    )
    message = F.when(
        F.array_contains("keys", "message"), F.coalesce("raw.message", F.lit("None"))
    ).otherwise(DEFAULT_API_MESSAGE)
    detail = F.when(c("status") == "API_ERROR", message).when(
        c("status") == "MISSING_FIELDS", F.concat_ws(", ", missing)
    )
    return parsed.withColumn("status", status).withColumn("detail", detail)


def _text(field: str, default: str | None = None) -> Column:
    """A field as text: the default if absent, the word None if null."""
    value = F.coalesce(c(f"raw.{field}"), F.lit("None"))
    if default is None:
        return value
    return F.when(F.array_contains("keys", field), value).otherwise(default)


def standardize_quotes(classified: DataFrame) -> DataFrame:
    """Add the 15 quote columns; unusable numbers turn the row invalid."""
    numbers = {
        "price": parse_float(c("raw.close")),
        "open_price": parse_float(c("raw.open")),
        "high_price": parse_float(c("raw.high")),
        "low_price": parse_float(c("raw.low")),
        "previous_close": parse_float(c("raw.previous_close")),
        "change": parse_float(c("raw.change")),
        "change_percent": parse_float(c("raw.percent_change")),
        "volume": parse_whole(c("raw.volume")),
    }
    texts = {
        "symbol": F.upper(strip(_text("symbol"))),
        "company_name": strip(_text("name", "")),
        "exchange": strip(_text("exchange", "")),
        "currency": strip(_text("currency", "USD")),
        "market_timestamp": _text("datetime"),
        "ingestion_timestamp": F.date_format(
            "run_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
        ),
        "source": F.lit(SOURCE_NAME),
    }
    quotes = settle(classified, {**texts, **numbers}, keep=["*"])
    usable = c("volume").isNotNull()
    for name in numbers:
        usable = usable & c(name).isNotNull()
    status = F.when((c("status") == OK) & ~usable, "INVALID_RESPONSE").otherwise(c("status"))
    return quotes.withColumn("status", status)


def validation_errors() -> Column:
    """The messages of all rules a standardized quote breaks, in fixed order."""
    low, high = c("low_price"), c("high_price")
    # The messages and their order.
    broken = {
        "symbol cannot be blank": strip(c("symbol")) == "",
        "price must be greater than zero": c("price") <= 0,
        "open_price must be greater than zero": c("open_price") <= 0,
        "high_price must be greater than zero": high <= 0,
        "low_price must be greater than zero": low <= 0,
        "previous_close must be greater than zero": c("previous_close") <= 0,
        "volume cannot be negative": c("volume") < 0,
        "high_price cannot be lower than low_price": below(high, low),
        "open_price must be between low_price and high_price": ~within(
            c("open_price"), low, high
        ),
        "price must be between low_price and high_price": ~within(c("price"), low, high),
        "market_timestamp cannot be blank": strip(c("market_timestamp")) == "",
        "ingestion_timestamp cannot be blank": strip(c("ingestion_timestamp")) == "",
    }
    return F.array_compact(F.array(*(F.when(cond, text) for text, cond in broken.items())))


def validate_quotes(standardized: DataFrame) -> DataFrame:
    """Mark quotes that break a rule and say which ones in ``detail``."""
    errors = F.concat_ws("; ", validation_errors())
    named = F.when(c("symbol") == "", "UNKNOWN").otherwise(c("symbol"))
    message = F.concat(F.lit("Validation failed for "), named, F.lit(": "), errors)
    failed = (c("status") == OK) & (errors != "")
    return standardized.withColumns(
        {
            "detail": F.when(failed, message).otherwise(c("detail")),
            "status": F.when(failed, "VALIDATION_FAILED").otherwise(c("status")),
        }
    )


def ingest(responses: DataFrame) -> DataFrame:
    """Classify, parse and validate; one row out for each response in."""
    return validate_quotes(standardize_quotes(classify_responses(responses)))


def raw_zone(ingested: DataFrame) -> DataFrame:
    """Responses that are kept raw: well-formed ones, even if not usable."""
    kept = c("status").isin(OK, "INVALID_RESPONSE", "VALIDATION_FAILED")
    return ingested.filter(kept).select(
        "run_timestamp", "position", "requested_symbol", "response"
    )


def standardized_zone(ingested: DataFrame) -> DataFrame:
    """Valid quotes with the run they came from."""
    return ingested.filter(c("status") == OK).select("run_timestamp", *QUOTE_COLUMNS)


def failed_symbols(ingested: DataFrame) -> DataFrame:
    """Every failed request of every run, in request order: its place, symbol and reason."""
    failed = ingested.filter(c("status") != OK).select(
        run_id(c("run_timestamp")).alias("run_id"),
        "position",
        "requested_symbol",
        "status",
        "detail",
    )
    return in_order(failed, "run_id", "position", "requested_symbol")


def ingest_summary(ingested: DataFrame) -> DataFrame:
    """One row per run: requests, successes and failures.

    The failed symbols are rows of ``failed_symbols``, in the same shape for
    any number of them.
    """
    good = c("status") == OK
    return ingested.groupBy(run_id(c("run_timestamp")).alias("run_id")).agg(
        F.count("*").alias("requested_count"),
        F.count_if(good).alias("successful_count"),
        F.count_if(~good).alias("failed_count"),
    )


def to_jsonl(rows: DataFrame) -> DataFrame:
    """Each row as one line of JSON; nulls and non-ASCII text are kept."""
    line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return rows.select(line.alias("value"))


def symbol_universe(requested: DataFrame) -> DataFrame:
    """Requested symbols stripped and in upper case; blanks go, repeats stay."""
    symbol = F.upper(strip(c("symbol")))
    return requested.withColumn("symbol", symbol).filter(c("symbol") != "")
