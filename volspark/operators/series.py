"""Dashboard data side: latest rows, KPIs, chart series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.functions import display_time, fixed6, money, money0
from volspark.schemas import LATEST_N

SERIES_COLUMNS = ["price_ma_1h", "price_ma_24h", "volatility_1h", "volatility_24h", "volume24h"]


def latest_n(df: DataFrame, n: int = LATEST_N, *, seq_col: str = "seq") -> DataFrame:
    """K2: the ``n`` most recent rows (TakeOrderedAndProject: per-partition top-n
    merged on the driver side of the plan, bounded by ``n``)."""
    return df.orderBy(F.desc("timestamp"), F.desc(seq_col)).limit(n)


def latest_kpis(df: DataFrame, *, seq_col: str = "seq") -> DataFrame:
    """K3 + P14: formatted price, 24h volatility, volume and time of the last row.

    One global aggregate (``max_by``) with map-side partial aggregation.
    """
    last = df.agg(F.max_by(F.struct("price", "volatility_24h", "volume24h", "datetime"),
                           F.struct("timestamp", seq_col)).alias("l"))
    return last.select(
        money("l.price").alias("current_price"),
        fixed6("l.volatility_24h").alias("current_volatility"),
        money0("l.volume24h").alias("current_volume"),
        display_time("l.datetime").alias("last_update"),
    )


def chart_series(df: DataFrame, columns, n: int = LATEST_N, *, seq_col: str = "seq") -> DataFrame:
    """``event_time`` plus ``columns`` for the latest ``n`` rows."""
    return latest_n(df, n, seq_col=seq_col).select("event_time", *columns)


def chart_price(df: DataFrame, n: int = LATEST_N) -> DataFrame:
    return chart_series(df, ["price", "price_ma_1h", "price_ma_24h", "volatility_24h"], n)


def chart_volatility(df: DataFrame, n: int = LATEST_N) -> DataFrame:
    return chart_series(df, ["volatility_1h", "volatility_24h"], n)


def chart_volume(df: DataFrame, n: int = LATEST_N) -> DataFrame:
    return chart_series(df, ["volume24h"], n)


def series_availability(df: DataFrame, columns=SERIES_COLUMNS) -> DataFrame:
    """Per metric column, is it present with any non-null value."""
    aggs = []
    for c in columns:
        if c in df.columns:
            aggs.append(F.bool_or(F.col(c).isNotNull()).alias(f"has_{c}"))
        else:
            aggs.append(F.lit(False).alias(f"has_{c}"))
    return df.agg(*aggs)
