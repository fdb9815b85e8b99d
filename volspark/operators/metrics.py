"""Volatility metrics on a tick series.

``tick_metrics`` adds, per row:

* ``log_return``        ln(price / previous price), N2 rules
* ``volatility_<h>h``   sample stddev of log returns over ``[t - h*3600, t]``,
                        0.0 with fewer than two returns
* ``price_ma_<h>h``     average price over the same frame, else the price
* ``price_change_pct``  (price - prev) / prev * 100, N5 rules

The previous price follows (timestamp, seq) order; the frames follow timestamp
only (peers included). ``keys`` names the series (none = one global series).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volspark.functions import change_pct, log_return, sample_stddev
from volspark.operators.rolling import (
    BK, SK, FrameAgg, add_blocks, add_series_bucket, bucket_width, rolling, rolling_by_second,
    with_previous,
)

HOUR = 3600
DAY = 86400

# Stand-ins for the API's 24h fields (test fixtures only): sum, max and min of
# price over the last 24 hours.
STANDIN_24H = {
    "volume24h": ("sum", "price", DAY),
    "high24h": ("max", "price", DAY),
    "low24h": ("min", "price", DAY),
}


def _metric_aggs(hours, extra):
    aggs = []
    for h in hours:
        sec = h * HOUR
        aggs += [
            FrameAgg(f"_nr{h}", "count", "log_return", sec),
            FrameAgg(f"_sr{h}", "sum", "log_return", sec),
            FrameAgg(f"_qr{h}", "sumsq", "log_return", sec),
            FrameAgg(f"_np{h}", "count", "price", sec),
            FrameAgg(f"_sp{h}", "sum", "price", sec),
        ]
    for name, (kind, column, sec) in (extra or {}).items():
        aggs.append(FrameAgg(name, kind, column, sec))
    return aggs


def tick_metrics(df: DataFrame, keys=(), *, time_col: str = "timestamp",
                 seq_col: str | None = "seq", price_col: str = "price",
                 hours=(1, 24), extra: dict | None = None,
                 bucket_seconds: int | None = None, block_rows: int | None = None,
                 spread: bool = True) -> DataFrame:
    """All metrics, distributed (see ``rolling``).

    Every series, keyed or not, takes the same way: work is partitioned by
    (series, bucket), so a hot series spreads over its buckets.
    ``bucket_seconds`` is the width of a bucket (default: the widest that
    divides every frame, at least ``rolling.MIN_BUCKET``); a narrower one splits
    bursts further at the price of more per-bucket totals. With ``block_rows`` a burst
    of any width, even within one second, is cut into blocks of about as many rows
    (``rolling.add_blocks``), at the price of more shuffles and of a stored copy of
    the rows below ``spark.checkpoint.dir``, written when this is called.
    ``spread`` fixes the number of tasks (``rolling.TASKS_PER_CORE``), so that no task's
    rows depend on how well they compress; without it small inputs take fewer tasks.

    ``seq_col`` breaks ties between equal timestamps for the previous price;
    when None, ``struct(datetime, price)`` is used if present (N7).
    ``extra`` maps output name -> (kind, column, seconds) for more frames.
    Rows with a NULL ``time_col`` cannot be placed in time: they are kept,
    with NULL metrics (``quality_check`` flags them for quarantine).
    """
    keys = list(keys)
    extra = extra or {}
    frames = [h * HOUR for h in hours] + [s for (_, _, s) in extra.values()]
    width = bucket_seconds or bucket_width(frames)
    # outputs replace input columns of the same name (e.g. recomputing history)
    outputs = ["log_return", "price_change_pct", *extra]
    outputs += [f"{m}_{h}h" for h in hours for m in ("volatility", "price_ma")]
    df = df.drop(*[c for c in outputs if c in df.columns])
    if price_col != "price":
        df = df.withColumnRenamed(price_col, "price")
    tie = seq_col
    if tie is None:
        tie = "_tie"
        tie_expr = (F.struct("datetime", "price") if "datetime" in df.columns
                    else F.struct("price"))
        df = df.withColumn(tie, tie_expr)
    lookahead = max(frames) // width - 1
    base = add_series_bucket(df, keys, time_col, width, F.col(tie), lookahead)
    if block_rows:
        base, lookahead = add_blocks(base, time_col, tie, block_rows), 0
    prev = with_previous(base, time_col, tie, "price", "_prev", lookahead=lookahead,
                         spread=spread)
    # one select per step: each withColumn would re-analyze the whole plan
    keep = [c for c in prev.columns if c != "_prev"]
    rets = prev.select(*keep, log_return("price", "_prev").alias("log_return"),
                       change_pct("price", "_prev").alias("price_change_pct"))
    metric_aggs = _metric_aggs(hours, extra)
    framed = (rolling_by_second(rets, time_col, metric_aggs, width, spread) if block_rows
              else rolling(rets, time_col, metric_aggs, width, order_cols=[time_col, tie], spread=spread))
    helper = {c for h in hours for c in (f"_nr{h}", f"_sr{h}", f"_qr{h}", f"_np{h}", f"_sp{h}")}
    helper |= {SK, BK}
    metric = {"log_return": F.col("log_return"), "price_change_pct": F.col("price_change_pct"),
              **{name: F.col(name) for name in extra}}
    for h in hours:
        metric[f"volatility_{h}h"] = F.coalesce(
            sample_stddev(f"_nr{h}", f"_sr{h}", f"_qr{h}"), F.lit(0.0))
        metric[f"price_ma_{h}h"] = F.coalesce(F.col(f"_sp{h}") / F.col(f"_np{h}"), F.col("price"))
    timed = F.col(time_col).isNotNull()
    out = framed.select(*[c for c in framed.columns if c not in helper and c not in metric],
                        *[F.when(timed, v).alias(name) for name, v in metric.items()])
    if seq_col is None:
        out = out.drop(tie)
    if price_col != "price":
        out = out.withColumnRenamed("price", price_col)
    return out


def tick_metrics_window(df: DataFrame, keys=(), *, time_col="timestamp", seq_col="seq",
                        hours=(1, 24), extra: dict | None = None) -> DataFrame:
    """The literal window form (one RANGE window per frame).

    Without keys this puts the whole series into ONE task and recomputes each
    sliding frame per row: the brute-force check of small fixtures in tests,
    used by nothing else. ``tick_metrics`` is the one for data.
    """
    keys = list(keys)
    wl = Window.partitionBy(*keys).orderBy(F.col(time_col), F.col(seq_col))
    prev = F.lag("price").over(wl)
    out = (df.withColumn("_prev", prev)
             .withColumn("log_return", log_return("price", "_prev"))
             .withColumn("price_change_pct", change_pct("price", "_prev")))
    for h in hours:
        w = Window.partitionBy(*keys).orderBy(F.col(time_col)).rangeBetween(-h * HOUR, 0)
        out = (out.withColumn(f"volatility_{h}h",
                              F.coalesce(F.stddev_samp("log_return").over(w), F.lit(0.0)))
                  .withColumn(f"price_ma_{h}h",
                              F.coalesce(F.avg("price").over(w), F.col("price"))))
    fns = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count,
           "sumsq": lambda c: F.sum(F.col(c) * F.col(c))}
    for name, (kind, column, sec) in (extra or {}).items():
        w = Window.partitionBy(*keys).orderBy(F.col(time_col)).rangeBetween(-sec, 0)
        out = out.withColumn(name, fns[kind](column).over(w))
    return out.drop("_prev")


def candle_metrics(candles: DataFrame, **kw) -> DataFrame:
    """Metrics over bulk-loaded candles, one series per (symbol, interval).

    Candles are unique per (symbol, interval, timestamp), so the timestamp
    itself is the tie-breaker.
    """
    c = candles.withColumn("_seq", F.col("timestamp"))
    return tick_metrics(c, keys=("symbol", "interval"), seq_col="_seq", **kw).drop("_seq")
