"""Batch analyses over tick metrics.

All functions are pure: DataFrame in, DataFrame out. Writing is separate
(``volspark.sinks``). A result set is the contract; ordering is applied where it
is the feature (top-k, head) and elsewhere on request (``ordered=True``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.functions import hour_of_day
from volspark.operators.quantile import quantile_approx, quantile_disc, threshold
from volspark.schemas import QUOTE_SCHEMA, SPIKE_COLUMNS, SPIKE_PERCENTILE, SPIKE_RELATIVE_ERROR, TOP_SPIKES


def require_columns(df: DataFrame, required) -> DataFrame:
    """P10: fail early with the list of missing columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def daily_stats(df: DataFrame, ordered: bool = False) -> DataFrame:
    """A1: per date price range, 24h-volatility stats, volume, count; ``ordered`` by date."""
    out = df.groupBy("date").agg(
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.avg("volatility_24h").alias("avg_vol"),
        F.max("volatility_24h").alias("max_vol"),
        F.min("volatility_24h").alias("min_vol"),
        F.stddev_samp("volatility_24h").alias("std_vol"),
        F.sum("volume24h").alias("total_volume"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return out.orderBy("date") if ordered else out


def daily_stats_head(df: DataFrame, n: int = 10) -> DataFrame:
    """K5: the first ``n`` days (ascending), a top-k, not a full sort."""
    return daily_stats(df).orderBy("date").limit(n)


def hourly_pattern(df: DataFrame, time_col: str = "event_time", ordered: bool = False) -> DataFrame:
    """A2: average 1h/24h volatility and count per UTC hour of day; ``ordered`` by hour."""
    out = (df.withColumn("hour_of_day", hour_of_day(time_col))
              .groupBy("hour_of_day")
              .agg(F.avg("volatility_1h").alias("avg_vol_1h"),
                   F.avg("volatility_24h").alias("avg_vol_24h"),
                   F.count(F.lit(1)).alias("record_count")))
    return out.orderBy("hour_of_day") if ordered else out


def peak_hour(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """A3: the hour with the highest average 1h volatility (ties: lowest hour)."""
    hp = hourly_pattern(df, time_col)
    best = F.max_by(F.struct("hour_of_day", "avg_vol_1h"),
                    F.struct(F.col("avg_vol_1h"), -F.col("hour_of_day")))
    return hp.agg(best.alias("b")).select("b.hour_of_day", "b.avg_vol_1h")


def spike_threshold(df: DataFrame, q: float = SPIKE_PERCENTILE, *, exact: bool = True,
                    relative_error: float = SPIKE_RELATIVE_ERROR) -> DataFrame:
    """A4: one-row ``quantile`` of ``volatility_24h``.

    exact=True: the k-th smallest value (``percentile_disc``), computed
    distributed. exact=False: the reference's approximate quantile with the
    given relative error (mergeable sketch).
    """
    if exact:
        return quantile_disc(df, "volatility_24h", q)
    return quantile_approx(df, "volatility_24h", q, relative_error)


def volatility_spikes(df: DataFrame, q: float = SPIKE_PERCENTILE, *, exact: bool = True,
                      ordered: bool = False, found: DataFrame | None = None) -> DataFrame:
    """Rows with volatility_24h strictly above the quantile (nulls out);
    ``ordered`` by volatility, largest first.

    The threshold is a scalar subquery: no join, no driver round trip. Empty
    or all-null input gives an empty result (the threshold is NULL). ``found`` is a
    threshold that is known already (one row, ``quantile``).
    """
    thr = threshold(spike_threshold(df, q, exact=exact) if found is None else found)
    out = df.filter(F.col("volatility_24h") > thr).select(*SPIKE_COLUMNS)
    return out.orderBy(F.desc("volatility_24h"), F.desc("datetime")) if ordered else out


def top_spikes(df: DataFrame, n: int = TOP_SPIKES, **kw) -> DataFrame:
    """K4: the ``n`` largest spikes (TakeOrderedAndProject, bounded memory)."""
    return volatility_spikes(df, **kw).orderBy(F.desc("volatility_24h"), F.desc("datetime")).limit(n)


def analysis_summary(df: DataFrame, q: float = SPIKE_PERCENTILE, *, exact: bool = True,
                     found: DataFrame | None = None) -> DataFrame:
    """A5: total records, days and spikes in one aggregation pass (``found``: see ``volatility_spikes``)."""
    thr = threshold(spike_threshold(df, q, exact=exact) if found is None else found)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("date").alias("total_days"),
        F.count_if(F.col("volatility_24h") > thr).alias("spike_count"),
    )


def feed_health(polls: DataFrame, body_col: str = "body") -> DataFrame:
    """Polled messages, errors and success rate (%) of quote envelopes.

    A message is an envelope that yields a tick (``flatten_quotes``): JSON that is
    no error response and has a quote of at least one currency. Error responses,
    text that is not JSON, empty envelopes and nulls are errors.
    """
    q = F.from_json(F.col(body_col), QUOTE_SCHEMA)
    quoted = F.exists(F.map_values(q["RAW"]), lambda by_currency: F.size(by_currency) > 0)
    ok = F.coalesce((F.coalesce(q["Response"], F.lit("")) != "Error") & quoted, F.lit(False))
    agg = polls.select(ok.alias("ok")).agg(F.count_if("ok").alias("messages"), F.count_if(~F.col("ok")).alias("errors"))
    total = F.col("messages") + F.col("errors")
    return agg.withColumn(
        "success_rate_pct",
        F.when(total > 0, F.col("messages") * 100.0 / total))


def candles(ticks: DataFrame, seconds: int, keys=("symbol",), *, seq_col: str = "seq") -> DataFrame:
    """OHLC candles per key and ``seconds`` bucket from ticks.

    open/close are the first/last price in (timestamp, seq) order; volumefrom
    is the number of ticks and volumeto the sum of prices (stand-ins for the
    API's volumes). Groups are (key, bucket), so a hot key spreads over its
    buckets.
    """
    order = F.struct("timestamp", seq_col)
    t = F.col("timestamp")
    return (ticks.withColumn("time", t - F.pmod(t, F.lit(seconds)))
                 .groupBy(*keys, "time")
                 .agg(F.min_by("price", order).alias("open"),
                      F.max("price").alias("high"),
                      F.min("price").alias("low"),
                      F.max_by("price", order).alias("close"),
                      F.count(F.lit(1)).cast("double").alias("volumefrom"),
                      F.sum("price").alias("volumeto")))
