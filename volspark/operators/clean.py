"""Parsing, normalizing and checking incoming data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volspark.functions import event_date, event_time, iso_datetime, quote_value
from volspark.schemas import (
    CANDLE_COLUMNS, CANDLE_RESPONSE_SCHEMA, QUOTE_SCHEMA, QUOTE_TO_TICK, TICK_SCHEMA,
)

MAX_TIMESTAMP = 4_102_444_799       # last second of the year 2099


def parse_ticks(df: DataFrame, value_col: str = "value", keep=(), schema=TICK_SCHEMA) -> DataFrame:
    """JSON text -> the typed fields of ``schema`` (the 12 tick fields) + ``keep`` columns.

    Malformed text gives an all-null row and a wrong-typed field a null field
    (PERMISSIVE ``from_json``); nothing is dropped here (see quality_check).
    A binary ``value`` (Kafka) is cast to string first.
    """
    v = F.col(value_col)
    if dict(df.dtypes).get(value_col) == "binary":
        v = v.cast("string")
    parsed = df.select(*keep, F.from_json(v, schema).alias("_p"))
    return parsed.select(*keep, *[F.col(f"_p.{c}").alias(c) for c in schema.fieldNames()])


def enrich_ticks(df: DataFrame) -> DataFrame:
    """P2 + P3: event_time from epoch seconds, date from event_time (UTC)."""
    return (df.withColumn("event_time", event_time("timestamp"))
              .withColumn("date", event_date("event_time")))


def quality_check(df: DataFrame, min_timestamp: int = 0,
                  max_timestamp: int = MAX_TIMESTAMP) -> DataFrame:
    """Add ``reject_reason`` (NULL = good).

    Rules, first match wins: timestamp present and within
    ``min_timestamp .. max_timestamp`` (seconds; milliseconds fall outside),
    price present, finite and > 0; volume24h finite and >= 0 when the column
    exists. Ticks with a price of zero or less are rejected, although the
    metrics define values for them: no market trades there, so such a price is
    a feed error. Split with ``good``/``quarantined``.
    """
    t, price = F.col("timestamp"), F.col("price").cast("double")
    reason = (F.when(t.isNull(), F.lit("null_timestamp"))
               .when((t < min_timestamp) | (t > max_timestamp), F.lit("timestamp_out_of_range"))
               .when(price.isNull(), F.lit("null_price"))
               .when(_not_finite(price), F.lit("non_finite_price"))
               .when(price <= 0, F.lit("non_positive_price")))
    if "volume24h" in df.columns:
        volume = F.col("volume24h").cast("double")
        reason = (reason.when(_not_finite(volume), F.lit("non_finite_volume"))
                  .when(volume < 0, F.lit("negative_volume")))
    return df.withColumn("reject_reason", reason)


def _not_finite(c: Column) -> Column:
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNotNull())


def flatten_quotes(df: DataFrame, body_col: str = "body", *, time_col: str = "timestamp",
                   keep=()) -> DataFrame:
    """S5 + P8: nested quote envelopes -> one tick row per (symbol, currency).

    Error envelopes (``Response = 'Error'``) and envelopes without RAW are
    removed. A number may come as text (``"123.5"``); absent, null and
    non-numeric fields become 0.0. ``time_col`` is the poll time of the
    envelope (epoch seconds).
    """
    p = df.select(*keep, F.col(time_col).alias("timestamp"),
                  F.from_json(F.col(body_col), QUOTE_SCHEMA).alias("_q"))
    p = p.filter(F.coalesce(F.col("_q.Response"), F.lit("")) != F.lit("Error"))
    by_symbol = p.select(*keep, "timestamp",
                         F.explode(F.col("_q.RAW")).alias("symbol", "_byccy"))
    by_ccy = by_symbol.select(*keep, "timestamp", "symbol",
                              F.explode("_byccy").alias("currency", "_f"))
    return by_ccy.select(
        *keep, "timestamp",
        iso_datetime(event_time("timestamp")).alias("datetime"),
        "symbol", "currency",
        *[quote_value(F.col(f"_f.{q}")).alias(t) for q, t in QUOTE_TO_TICK])


def parse_candle_responses(df: DataFrame, body_col: str = "body",
                           keep=("symbol", "interval")) -> DataFrame:
    """Candle API responses -> one row per raw candle; non-Success skipped."""
    p = df.select(*keep, F.from_json(F.col(body_col), CANDLE_RESPONSE_SCHEMA).alias("_r"))
    p = p.filter(F.col("_r.Response") == F.lit("Success"))
    rows = p.select(*keep, F.explode("_r.Data.Data").alias("_c"))
    return rows.select(*keep, "_c.*")


def latest_candles(df: DataFrame, version: str) -> DataFrame:
    """One candle per (symbol, interval, timestamp): the one of the newest ``version``.

    Candles of one version that differ are settled by their values, so the result
    does not depend on the order of rows. ``version`` is not returned.
    """
    key = ["symbol", "interval", "timestamp"]
    values = [c for c in df.columns if c not in (*key, version)]
    newest = F.max_by(F.struct(*values), F.struct(version, *values))
    return df.groupBy(*key).agg(newest.alias("_c")).select(*[c if c in key else F.col(f"_c.{c}").alias(c)
                                                             for c in df.columns if c != version])


def candle_gaps(candles: DataFrame, steps: dict[str, int]) -> DataFrame:
    """Missing and repeated ranges of candle pages, per (symbol, interval).

    ``steps``: seconds between candles per interval name. A ``missing`` range is
    what lies between two neighbouring candles more than one step apart; a
    ``repeated`` range is a run of successive candles that all came more than once.
    ``first`` and ``last`` are the range's outer timestamps, ``candles`` how many are
    missing or superfluous. Candles without a timestamp and other intervals are left out.
    """
    series = ["symbol", "interval"]
    step = F.coalesce(*[F.when(F.col("interval") == name, F.lit(seconds)) for name, seconds in steps.items()])
    times = (candles.groupBy(*series, "timestamp").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("step", step.cast("long")).where("step is not null and timestamp is not null"))
    in_time = Window.partitionBy(*series).orderBy("timestamp")
    missing = (times.withColumn("next", F.lead("timestamp").over(in_time)).where("next - timestamp > step")
               .select(*series, F.lit("missing").alias("kind"), (F.col("timestamp") + F.col("step")).alias("first"),
                       (F.col("next") - F.col("step")).alias("last"),
                       F.expr("(next - timestamp - 1) div step").alias("candles")))
    # successive candles of a run share their time minus their rank's steps
    island = F.col("timestamp") - F.row_number().over(in_time) * F.col("step")
    repeated = (times.where("n > 1").withColumn("island", island).groupBy(*series, "island")
                .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
                     F.sum(F.col("n") - 1).alias("candles"))
                .select(*series, F.lit("repeated").alias("kind"), "first", "last", "candles"))
    return missing.unionByName(repeated)


def normalize_candles(df: DataFrame, symbol=None, interval=None, keep=()) -> DataFrame:
    """Raw candle columns -> the 11 stored columns in fixed order (and ``keep``).

    time -> timestamp, close -> price, volumefrom -> volume; datetime is a
    timestamp and date a ``yyyy-MM-dd`` string (as the bulk files store them).
    ``symbol``/``interval`` literals are used when the rows lack the columns.
    """
    if symbol is not None:
        df = df.withColumn("symbol", F.lit(symbol))
    if interval is not None:
        df = df.withColumn("interval", F.lit(interval))
    dtm = event_time("time")
    out = df.select(
        F.col("time").alias("timestamp"),
        dtm.alias("datetime"),
        F.date_format(dtm, "yyyy-MM-dd").alias("date"),
        F.col("symbol").cast("string").alias("symbol"),
        F.col("interval").cast("string").alias("interval"),
        F.col("close").alias("price"),
        "open", "high", "low",
        F.col("volumefrom").alias("volume"),
        "volumeto", *keep,
    )
    return out.select(*CANDLE_COLUMNS, *keep)


def history_merge(streamed: DataFrame, bulk: DataFrame, steps: dict[str, int]) -> DataFrame:
    """U1 without double counting: bulk candles only where the ticks of their symbol leave a hole.

    A candle covers ``[timestamp, timestamp + step)``, ``steps`` being the seconds per
    interval name; it is left out as soon as one tick of its symbol lies in there.
    Of candles of several intervals the coarser one is left out where a finer one
    of the symbol is kept. Candles of other intervals are errors of the caller.
    """
    bulk = bulk.withColumn("symbol", F.col("symbol").cast("string"))
    taken = streamed.select(F.col("symbol").cast("string").alias("symbol"), "timestamp")
    kept = None
    for name, seconds in sorted(steps.items(), key=lambda s: s[1]):
        own = bulk.where(F.col("interval") == name)
        slot = lambda t: F.floor(F.col(t) / F.lit(seconds)).alias("_slot")
        covered = taken.select("symbol", slot("timestamp")).distinct()
        own = own.select("*", slot("timestamp")).join(covered, ["symbol", "_slot"], "left_anti").select(*bulk.columns)
        kept = own if kept is None else kept.unionByName(own)
        taken = taken.unionByName(own.select("symbol", "timestamp"))
    other = ~F.coalesce(F.col("interval").isin(list(steps)), F.lit(False))
    unknown = F.raise_error(F.concat(F.lit("no step for interval "), F.coalesce("interval", F.lit("null"))))
    return history_union(streamed, kept.unionByName(bulk.where(F.when(other, unknown.cast("boolean")).otherwise(False))))


def history_union(streamed: DataFrame, bulk: DataFrame) -> DataFrame:
    """Streamed ticks and bulk candles as one history, with a ``source``.

    Types are aligned first (bulk ``datetime`` timestamp -> ISO text, bulk
    ``date`` text -> DATE, symbol -> string), then ``unionByName`` keeps the
    columns one side lacks as NULL.
    """
    s = streamed
    if "symbol" in s.columns:
        s = s.withColumn("symbol", F.col("symbol").cast("string"))
    s = s.withColumn("source", F.lit("stream"))
    b = (bulk.withColumn("datetime", iso_datetime("datetime"))
             .withColumn("date", F.to_date("date"))
             .withColumn("source", F.lit("bulk")))
    return s.unionByName(b, allowMissingColumns=True)
