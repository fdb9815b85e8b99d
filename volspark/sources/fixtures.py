"""Tick inputs derived from the driver's ``events`` table (FIXTURES.md §2).

timestamp = whole epoch seconds of ``ts``; seq = event_id; symbol = user_id;
price = value. Everything is derived by Spark from the table, so the work
grows with it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.functions import event_date, event_time, hour_of_day, iso_datetime
from volspark.session import ensure_conf


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # epoch seconds of the TIMESTAMP_NTZ column, dates and hours are UTC by
    # contract: pin the session zone before any expression is built
    ensure_conf(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events_to_ticks(events: DataFrame) -> DataFrame:
    """Tick rows: timestamp, seq, symbol, price, datetime, event_time, date, hour_of_day."""
    t = F.unix_timestamp(F.col("ts")).cast("long")
    return events.select(
        t.alias("timestamp"),
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("symbol"),
        F.col("value").alias("price"),
        iso_datetime(F.col("ts")).alias("datetime"),
        event_time(t).alias("event_time"),
        event_date(event_time(t)).alias("date"),
        hour_of_day(event_time(t)).alias("hour_of_day"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_ticks(read_table(spark, sf_dir, "events"))


# --- derived inputs for the ingest operators (FIXTURES.md §2) -------------------

QUOTE_CURRENCY = "USD"
CANDLE_PAGE = 2000          # candles per API response page


def full_ticks(ticks_df: DataFrame, keep=()) -> DataFrame:
    """The 12 tick fields (and seq, ``keep``): the other nine are price + 1 .. price + 9."""
    from volspark.schemas import TICK_FIELDS
    rest = [(F.col("price") + F.lit(float(i + 1))).alias(c) for i, c in enumerate(TICK_FIELDS[3:])]
    return ticks_df.select("seq", *keep, *TICK_FIELDS[:3], *rest)


def tick_json(ticks_df: DataFrame) -> DataFrame:
    """(seq, value): each tick serialized as one JSON message of the 12 fields."""
    from volspark.schemas import TICK_FIELDS
    return full_ticks(ticks_df).select("seq", F.to_json(F.struct(*TICK_FIELDS)).alias("value"))


def quote_envelopes(events: DataFrame) -> DataFrame:
    """(seq, timestamp, body): one nested quote envelope per event.

    symbol = 'S' || user_id, currency USD, PRICE = value, the other fields
    value + i (i = 1..9); event_id % 7 = 0 leaves the other fields out and
    event_id % 50 = 0 is an error envelope. event_id % 11 = 3 sends all numbers
    as text, 4 junk text in OPEN24HOUR, 5 an explicit null in HIGH24HOUR. Polls
    that failed otherwise: event_id % 53 = 1 is not JSON, % 59 = 2 an empty envelope.
    """
    from volspark.schemas import QUOTE_TO_TICK
    t = F.unix_timestamp(F.col("ts")).cast("long")
    v = F.col("value")
    kind = F.col("event_id") % 11

    def field(i: int, q: str):
        x = v if i == 0 else v + F.lit(float(i))
        text = F.concat(F.lit('"'), x.cast("string"), F.lit('"'))
        value = F.when(kind == 3, text).otherwise(x.cast("string"))
        if q == "OPEN24HOUR":
            value = F.when(kind == 4, F.lit('"n/a"')).otherwise(value)
        if q == "HIGH24HOUR":
            value = F.when(kind == 5, F.lit("null")).otherwise(value)
        return F.concat(F.lit(f'"{q}":'), value)

    fields = [field(i, q) for i, (q, _) in enumerate(QUOTE_TO_TICK)]
    full, short = F.concat_ws(",", *fields), fields[0]
    sym = F.concat(F.lit("S"), F.col("user_id").cast("string"))
    inner = F.when(F.col("event_id") % 7 == 0, short).otherwise(full)
    raw = F.concat(F.lit('{"'), sym, F.lit('":{"' + QUOTE_CURRENCY + '":{'), inner, F.lit("}}}"))
    ok_body = F.concat(F.lit('{"RAW":'), raw, F.lit("}"))
    err_body = F.lit('{"Response":"Error","Message":"rate limit exceeded"}')
    body = (F.when(F.col("event_id") % 50 == 0, err_body)
             .when(F.col("event_id") % 53 == 1, F.lit("<html>bad gateway</html>"))
             .when(F.col("event_id") % 59 == 2, F.lit("{}")).otherwise(ok_body))
    return events.select(F.col("event_id").alias("seq"), t.alias("timestamp"), body.alias("body"))


def candle_responses(ticks_df: DataFrame, seconds: int = 3600,
                     interval: str = "hourly") -> DataFrame:
    """(symbol, interval, body): candle API responses of at most 2000 candles.

    Candles come from ticks (A7); each (symbol, page) becomes one Success
    response, and each symbol also gets one Error response to skip. Pages
    bound every collected group to CANDLE_PAGE rows.
    """
    from volspark.operators.analysis import candles
    c = candles(ticks_df, seconds).withColumn(
        "symbol", F.concat(F.lit("S"), F.col("symbol").cast("string")))
    page = F.floor(F.col("time") / F.lit(seconds * CANDLE_PAGE))
    item = F.struct("time", "open", "high", "low", "close", "volumefrom", "volumeto")
    pages = (c.groupBy("symbol", page.alias("_page"))
              .agg(F.sort_array(F.collect_list(item)).alias("_items")))
    ok = pages.select(
        "symbol", F.lit(interval).alias("interval"),
        F.to_json(F.struct(F.lit("Success").alias("Response"), F.lit("").alias("Message"),
                           F.struct(F.col("_items").alias("Data")).alias("Data"))).alias("body"))
    err = (c.select("symbol").distinct()
             .select("symbol", F.lit(interval).alias("interval"),
                     F.lit('{"Response":"Error","Message":"limit"}').alias("body")))
    return ok.unionByName(err)


def landings(ticks_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ticks of two candle polls that overlap: the first 60 % by seq, whose last hour is
    partial, and all from the hour in which the second half begins."""
    ends = ticks_df.agg(F.min("seq").alias("least"), F.max("seq").alias("most"))
    least, most = (ends.select(c).scalar() for c in ("least", "most"))
    at = lambda n: F.floor((F.col("seq") - least) * n / (most - least + 1))
    half = ticks_df.where(at(2) >= 1).agg(F.min("timestamp").alias("t")).select((F.col("t") - F.col("t") % 3600).alias("t"))
    return ticks_df.where(at(5) < 3), ticks_df.where(F.col("timestamp") >= half.scalar())


def quality_input(ticks_df: DataFrame) -> DataFrame:
    """Dirty ticks by seq % 11: price 0 (0), negative (1), NULL (2), NaN (4), infinite (5);
    timestamp in milliseconds (3), NULL (6); volume24h -1 (7), NaN (8), else the price."""
    m, price = F.col("seq") % 11, F.col("price")
    p = (F.when(m == 0, F.lit(0.0)).when(m == 1, -price).when(m == 2, F.lit(None).cast("double"))
          .when(m == 4, F.lit(float("nan"))).when(m == 5, F.lit(float("inf"))).otherwise(price))
    t = F.when(m == 3, F.col("timestamp") * 1000).when(m != 6, F.col("timestamp"))
    volume = F.when(m == 7, F.lit(-1.0)).when(m == 8, F.lit(float("nan"))).otherwise(price)
    return ticks_df.withColumns({"price": p, "timestamp": t, "volume24h": volume})
