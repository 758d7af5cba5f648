"""Quotes, responses and requests derived from the sample tables.

Every row of a table becomes one row here. The remainders only choose which
fault, if any, a row is given; no row is left out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curate import (
    assess,
    curated_quotes,
    typed_quotes,
    valid_quotes,
    with_market_date,
)

RUN_TIME = datetime(2024, 2, 1, 12, 0, 0)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

c = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return c("event_id") % n == 0


def _cents(value: str) -> str:
    return f"cast(cast({value} / cast(100 as decimal(5,0)) as decimal(18,2)) as string)"


def _clean_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote texts without faults, with the numbers the faults are made from."""
    events = table(spark, sf_dir, "events")
    return (
        events.selectExpr(
            "event_id",
            "user_id",
            "ts",
            "cast(get_json_object(props, '$.k') as int) as k",
            "cast(round(value * 100) as bigint) as v",
            "5000 + user_id * 100 as pc",
        )
        .selectExpr("*", "(v % 1000) * if(k % 2 = 1, 1, -1) as chg")
        .selectExpr("*", "pc + chg as pr")
        .selectExpr(
            "*",
            "greatest(pr, pc) + k as hi",
            "least(pr, pc) - k % 7 as lo",
            "lpad(cast(user_id % 20 as string), 3, '0') as id3",
        )
    )


def standardized_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized text rows, one per event; each rejection rule is broken."""
    e = F.expr
    columns = {
        "symbol": F.when(_every(97), F.lit("   "))
        .when(_every(89), e("' s' || id3 || ' '"))
        .otherwise(e("'S' || id3")),
        "company_name": e("'Company ' || id3 || ' '"),
        "exchange": F.when(c("user_id") % 3 == 0, "NASDAQ")
        .when(c("user_id") % 3 == 1, "NYSE")
        .otherwise(" amex "),
        "currency": F.when(c("user_id") % 5 == 0, "usd ").otherwise("USD"),
        "price": F.when(_every(101), "-1.00").when(_every(103), "abc").otherwise(e(_cents("pr"))),
        "open_price": e(_cents("pc")),
        "high_price": F.when(_every(127), e(_cents("(lo - 1)"))).otherwise(e(_cents("hi"))),
        "low_price": e(_cents("lo")),
        "previous_close": e(_cents("pc")),
        "change": e(_cents("chg")),
        "change_percent": e(
            "cast(cast(chg * cast(100 as decimal(5,0)) / pc as decimal(18,4)) as string)"
        ),
        "volume": F.when(_every(113), "-5")
        .when(_every(17), None)
        .otherwise(e("cast((k + 1) * 10000 as string)")),
        "market_timestamp": F.when(_every(107), "not-a-date").otherwise(
            F.date_format(F.date_trunc("hour", "ts"), ISO)
        ),
        "ingestion_timestamp": F.when(_every(109), "bad").otherwise(F.date_format("ts", ISO)),
        "source": F.when(_every(2), " Twelve_Data").otherwise("twelve_data"),
    }
    return _clean_quotes(spark, sf_dir).select(
        *(column.alias(name) for name, column in columns.items()),
        F.lit("events").alias("source_file"),
        "event_id",
        "ts",
    )


def assessed_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(standardized_from_events(spark, sf_dir))


def valid_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid quotes before deduplication, with partition columns."""
    return with_market_date(valid_quotes(assessed_from_events(spark, sf_dir)))


def curated_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated_quotes(standardized_from_events(spark, sf_dir))


def faulty_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed quotes before the split, with a fault for every quality check."""
    typed = typed_quotes(standardized_from_events(spark, sf_dir), keep=["event_id"])
    sloppy = {
        name: F.when(_every(137), F.concat(F.lit(" "), F.lower(name))).otherwise(c(name))
        for name in ("symbol", "exchange", "currency")
    }
    ingested, market = c("ingestion_timestamp"), c("market_timestamp")
    day = F.make_dt_interval(days=F.lit(1))
    faults = {
        **sloppy,
        "source": F.when(_every(137), F.upper("source")).otherwise(c("source")),
        "price": F.when(_every(131), c("high_price") + 1)
        .when(_every(191), F.lit(float("nan")))
        .otherwise(c("price")),
        "high_price": F.when(_every(173), F.lit(float("nan"))).otherwise(c("high_price")),
        "low_price": F.when(_every(179), F.lit(float("nan"))).otherwise(c("low_price")),
        "ingestion_timestamp": F.when(_every(139), market - day)
        .when(_every(149), ingested + F.make_dt_interval(hours=F.lit(26)))
        .otherwise(ingested),
        "change": F.when(_every(163), c("change") + 0.05).otherwise(c("change")),
        "change_percent": F.when(_every(167), c("change_percent") + 0.1)
        .when(_every(181), F.lit(float("nan")))
        .otherwise(c("change_percent")),
    }
    return (
        with_market_date(typed.withColumns(faults))
        .withColumns(
            {
                "day": F.when(_every(151), "32").otherwise(c("day")),
                "month": F.when(_every(157), "7").otherwise(c("month")),
            }
        )
        .drop("event_id", "source_file")
    )


def responses_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw responses, one per event; a run is six hours of events."""
    e = F.expr
    fields = {
        "symbol": F.when(_every(157), None).otherwise(e("'s' || id3")),
        "name": e("'Company ' || id3"),
        "exchange": F.when(c("user_id") % 3 == 0, "NASDAQ")
        .when(c("user_id") % 3 == 1, "NYSE")
        .otherwise("AMEX"),
        "currency": F.lit("USD"),
        "close": F.when(_every(151), e(_cents("(hi + 100)"))).otherwise(e(_cents("pr"))),
        "open": e(_cents("pc")),
        "high": e(_cents("hi")),
        "low": e(_cents("lo")),
        "previous_close": e(_cents("pc")),
        "change": e(_cents("chg")),
        "percent_change": e(
            "cast(cast(chg * cast(100 as decimal(5,0)) / pc as decimal(18,4)) as string)"
        ),
        "volume": F.when(_every(149), "n/a").otherwise(e("cast((k + 1) * 10000 as string)")),
        "datetime": F.date_format(F.date_trunc("hour", "ts"), ISO),
    }
    # The fields are columns of their own, worked out once for both texts: written
    # into each text, they make code too long for the JVM to compile.
    quotes = _clean_quotes(spark, sf_dir).select(
        F.window("ts", "6 hours")["start"].alias("run_timestamp"),
        c("event_id").alias("position"),
        e("'S' || id3").alias("requested_symbol"),
        "event_id",
        *(v.alias(f"_{n}") for n, v in fields.items()),
    )
    keep_null = {"ignoreNullFields": "false"}
    full = F.to_json(F.struct(*(c(f"_{n}").alias(n) for n in fields)), keep_null)
    no_close = F.to_json(
        F.struct(*(c(f"_{n}").alias(n) for n in fields if n != "close")), keep_null
    )
    response = (
        F.when(_every(131), '{"status":"error","message":"API limit reached"}')
        .when(_every(137), no_close)
        .when(_every(139), "not json")
        .when(_every(83), F.replace(c("_full"), F.lit(',"'), F.lit(',\r\n  "')))
        .otherwise(c("_full"))
    )
    return quotes.withColumn("_full", full).select(
        "run_timestamp", "position", "requested_symbol", response.alias("response")
    )


def requests_from_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A requested symbol per nation, untidy, one of them blank."""
    key = c("n_nationkey")
    name = F.concat(F.lit(" s"), F.lpad((key * 3).cast("string"), 3, "0"), F.lit("\t"))
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("position"),
        F.when(key == 7, F.lit("  ")).otherwise(name).alias("symbol"),
    )


def quotes_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized rows from the largest table, for timing."""
    part = "'P' || cast(l_partkey as string)"
    price = "l_extendedprice / l_quantity"
    columns = {
        "symbol": part,
        "company_name": "'Part ' || cast(l_partkey as string)",
        "exchange": "case l_partkey % 3 when 0 then 'NASDAQ' when 1 then 'NYSE' else 'AMEX' end",
        "currency": "'USD'",
        "price": price,
        "open_price": f"{price} * (1 - l_discount)",
        "high_price": f"{price} * (1 + l_tax)",
        "low_price": f"{price} * (1 - l_discount - l_tax)",
        "previous_close": f"{price} * (1 - l_discount)",
        "change": f"{price} * l_discount",
        "change_percent": "100 * l_discount / (1 - l_discount)",
        "volume": "cast(l_quantity as bigint)",
        "market_timestamp": "l_shipdate",
        "ingestion_timestamp": "l_shipdate + make_dt_interval(0, l_orderkey % 48)",
        "source": "l_returnflag",
    }
    texts = (f"cast({expr} as string) as {name}" for name, expr in columns.items())
    return table(spark, sf_dir, "lineitem").selectExpr(
        *texts, "'lineitem' as source_file"
    )

