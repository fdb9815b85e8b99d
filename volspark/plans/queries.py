"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Every query reads the driver's tables (whole tables, no row caps) and derives
its input with Spark. Metric outputs go through the comparison rounding of
``volspark.plans.oracle`` (R6 for metrics, R2 for sums).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.functions import round2, round6
from volspark import sinks
from volspark.operators import analysis as A
from volspark.operators import clean as C
from volspark.operators import series as S
from volspark.plans import jobs
from volspark.plans import streams as ST
from volspark.operators.metrics import STANDIN_24H, candle_metrics, tick_metrics
from volspark.schemas import (
    ANALYSIS_REQUIRED, CANDLE_COLUMNS, DASHBOARD_SCHEMA, HISTORY_MIN_GB, LATEST_N,
    SPIKE_COLUMNS, SPIKE_PERCENTILE, SPIKE_RELATIVE_ERROR, stream_tick_schema,
)
from volspark.session import ensure_conf, keep, scratch_path
from volspark.sources import files
from volspark.sources import fixtures as FX
from volspark.sources.fixtures import ticks

QueryFn = Callable[[SparkSession, str], DataFrame]

METRIC_R6 = ["log_return", "price_change_pct", "volatility_1h", "volatility_24h",
             "price_ma_1h", "price_ma_24h", "avg_price", "avg_vol", "max_vol", "min_vol",
             "std_vol", "avg_vol_1h", "avg_vol_24h", "threshold"]
SUM_R2 = ["volume24h", "total_volume", "volumeto"]


def report(df: DataFrame) -> DataFrame:
    """Apply the comparison rounding to known metric/sum columns."""
    cols = []
    for c in df.columns:
        if c in METRIC_R6:
            cols.append(round6(c).alias(c))
        elif c in SUM_R2:
            cols.append(round2(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def metrics(spark: SparkSession, sf_dir: str, keys=(), **kw) -> DataFrame:
    ensure_conf(spark)
    return tick_metrics(ticks(spark, sf_dir), keys, extra=STANDIN_24H, **kw)


def _mat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric columns that the multi-pass analyses read, stored once."""
    return keep(metrics(spark, sf_dir).select(*SPIKE_COLUMNS), "spike-metrics")


METRIC_COLS = ["seq", "timestamp", "price", "log_return", "price_change_pct",
               "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h",
               "volume24h", "high24h", "low24h"]


def _metric_column(name: str, hours=(1, 24), extra=None) -> QueryFn:
    def q(spark, sf_dir):
        ensure_conf(spark)
        m = tick_metrics(ticks(spark, sf_dir), (), hours=hours, extra=extra)
        return report(m.select("seq", name))
    return q


def registry() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {}
    q["tick_metrics"] = lambda s, d: report(metrics(s, d).select(*METRIC_COLS))
    q["tick_metrics_by_symbol"] = lambda s, d: report(
        metrics(s, d, keys=("symbol",)).select("seq", "symbol", *METRIC_COLS[1:]))
    q["tick_metrics_bucketed"] = lambda s, d: report(
        metrics(s, d, bucket_seconds=900).select(*METRIC_COLS))
    q["tick_metrics_blocks"] = lambda s, d: report(       # blocks of about 8 ticks of an hour
        metrics(s, d, block_rows=8).select(*METRIC_COLS))
    q["log_return"] = _metric_column("log_return", hours=(1,))
    q["price_change_pct"] = _metric_column("price_change_pct", hours=(1,))
    q["volatility_1h"] = _metric_column("volatility_1h", hours=(1,))
    q["volatility_24h"] = _metric_column("volatility_24h", hours=(24,))
    q["price_ma_1h"] = _metric_column("price_ma_1h", hours=(1,))
    q["price_ma_24h"] = _metric_column("price_ma_24h", hours=(24,))
    q["daily_stats"] = lambda s, d: report(A.daily_stats(metrics(s, d)))
    q["daily_stats_head"] = lambda s, d: report(A.daily_stats_head(metrics(s, d)))
    q["hourly_pattern"] = lambda s, d: report(A.hourly_pattern(metrics(s, d)))
    q["peak_hour"] = lambda s, d: report(A.peak_hour(metrics(s, d)))
    # multi-pass analyses (sketch, band, filter) read materialized metrics
    q["spike_threshold"] = lambda s, d: report(
        A.spike_threshold(_mat(s, d)).withColumnRenamed("quantile", "threshold"))
    q["spike_threshold_approx"] = _threshold_rank
    q["volatility_spikes"] = lambda s, d: report(A.volatility_spikes(_mat(s, d)))
    q["top_spikes"] = lambda s, d: report(A.top_spikes(_mat(s, d)))
    q["analysis_summary"] = lambda s, d: A.analysis_summary(_mat(s, d))
    q["event_time_enrich"] = lambda s, d: ticks(s, d).select("seq", "timestamp", "event_time", "date")
    q["dashboard_projection"] = lambda s, d: report(_dashboard(metrics(s, d)))
    q["latest_n"] = lambda s, d: S.latest_n(ticks(s, d)).select("seq", "timestamp", "price")
    # the dashboard reads the newest dates of the stored metrics
    q["latest_kpis"] = lambda s, d: S.latest_kpis(_stored_latest(s, d, 1))
    q["chart_price"] = lambda s, d: report(S.chart_price(_stored_latest(s, d)))
    q["chart_volatility"] = lambda s, d: report(S.chart_volatility(_stored_latest(s, d)))
    q["chart_volume"] = lambda s, d: report(S.chart_volume(_stored_latest(s, d)))
    q["latest_n_zoned"] = lambda s, d: S.latest_n(_zoned_latest(s, d)).select("seq", "timestamp", "price")
    q["series_availability"] = lambda s, d: S.series_availability(S.latest_n(_stored_latest(s, d)))
    q["candle_minute"] = lambda s, d: report(A.candles(ticks(s, d), 60))
    q["candle_hour"] = lambda s, d: report(A.candles(ticks(s, d), 3600))
    q["sql_avg_price_by_date"] = _sql_avg_price_by_date
    # --- ingest side
    q["tick_parse"] = lambda s, d: C.parse_ticks(FX.tick_json(ticks(s, d)), keep=("seq",))
    q["tick_serialize"] = lambda s, d: FX.tick_json(ticks(s, d))
    q["json_ticks_roundtrip"] = _json_ticks_roundtrip
    q["quote_flatten"] = lambda s, d: _quotes(s, d).select(
        "seq", "timestamp", "datetime", "symbol", "currency", "price")
    q["quote_defaults"] = lambda s, d: _quotes(s, d).select(
        "seq", "open24h", "high24h", "low24h", "volume24h", "volumeto24h", "change24h",
        "changepct24h", "market_cap", "supply")
    q["feed_health"] = lambda s, d: A.feed_health(FX.quote_envelopes(FX.read_table(s, d, "events")))
    q["candle_parse"] = lambda s, d: report(_candle_raw(s, d))
    q["candle_normalize"] = lambda s, d: report(_candles(s, d))
    q["candle_metrics"] = lambda s, d: report(candle_metrics(_candles(s, d)).select(
        "symbol", "interval", "timestamp", "price", "log_return", "price_change_pct",
        "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h"))
    q["quality_check"] = lambda s, d: C.quality_check(
        FX.quality_input(ticks(s, d)).select("seq", "timestamp", "price", "volume24h")).select(
        "seq", F.when(F.col("reject_reason").isNull(), F.col("price")).alias("price"), "reject_reason")
    q["schema_guard"] = lambda s, d: report(
        A.require_columns(metrics(s, d), ANALYSIS_REQUIRED).select(*ANALYSIS_REQUIRED))
    q["history_union"] = lambda s, d: C.history_union(
        ticks(s, d).select("timestamp", "datetime", "date", "symbol", "price"),
        _candles(s, d).select("timestamp", "datetime", "date", "symbol", "interval", "price"))
    q["history_merge"] = _history_merge
    # --- sinks, read back
    q["history_write_read"] = lambda s, d: report(_history(s, d).select(*METRIC_COLS, "date"))
    q["history_scan_pruned"] = lambda s, d: report(
        _history(s, d, date_from="2024-01-24").select(*METRIC_COLS, "date"))
    q["analysis_roundtrip"] = _analysis_roundtrip
    q["candle_write_read"] = _candle_write_read
    q["volume_audit"] = _volume_audit
    # --- jobs
    q["batch_job_summary"] = _batch_job_summary
    q["daily_stats_incremental"] = lambda s, d: report(s.read.parquet(_incremental(s, d)["daily_stats"]))
    q["hourly_pattern_incremental"] = lambda s, d: report(s.read.parquet(_incremental(s, d)["hourly_pattern"]))
    q["spike_threshold_incremental"] = lambda s, d: report(
        s.read.parquet(_incremental(s, d)["threshold"]).withColumnRenamed("quantile", "threshold"))
    q["volatility_spikes_incremental"] = lambda s, d: report(s.read.parquet(_incremental(s, d)["volatility_spikes"]))
    q["backfill_job"] = _backfill_job
    q["backfill_incremental"] = _backfill_incremental
    q["candle_gaps"] = _candle_gaps
    q["quote_job"] = _quote_job
    # --- streaming
    q["stream_tick_metrics"] = lambda s, d: _stream_metrics(s, ST.rolling_stream(s, d))
    q["stream_restart"] = lambda s, d: _stream_metrics(s, ST.rolling_stream(s, d, restart=True))
    q["stream_late_ticks"] = lambda s, d: _stream_metrics(s, ST.rolling_stream(s, d, late=True))
    q["stream_replay"] = lambda s, d: _stream_metrics(s, ST.replayed(s, d))
    q["stream_no_seq"] = lambda s, d: report(_stream_out(
        s, ST.rolling_stream(s, d, with_seq=False)).select("datetime", *METRIC_COLS[1:]))
    q["stream_wide_frames"] = lambda s, d: _wide(_stream_out(s, ST.rolling_stream(
        s, d, late=True, hours=(1, 48), extra={}, dashboard=False, slot_hours=12)))
    q["stream_fanout"] = _stream_fanout
    q["stream_stateful_metrics"] = lambda s, d: report(
        _stream_out(s, ST.stateful_stream(s, d)).select("seq", "symbol", *METRIC_COLS[1:]))
    q["stream_stateful_late"] = _stream_stateful_late
    q["stream_metrics_per_batch"] = lambda s, d: report(
        s.read.parquet(ST.per_batch(s, d)).select(
            F.col("ingest_batch").cast("bigint").alias("ingest_batch"), *METRIC_COLS))
    return q


def _stream_out(spark, base):
    return spark.read.parquet(os.path.join(base, "metrics"))


def _stream_metrics(spark, base):
    return report(_stream_out(spark, base).select(*METRIC_COLS))


def _threshold_rank(spark, sf_dir):
    """A4, approximate mode: its rank is within the relative error of the asked one."""
    m = keep(metrics(spark, sf_dir).select("volatility_24h"), "volatility")
    found = A.spike_threshold(m, exact=False).select("quantile").scalar()
    at = m.select("volatility_24h", found.alias("threshold")).agg(
        (F.count_if(F.col("volatility_24h") < F.col("threshold")) / F.count("volatility_24h")).alias("below"),
        (F.count_if(F.col("volatility_24h") <= F.col("threshold")) / F.count("volatility_24h")).alias("upto"))
    return at.select(((F.col("below") <= SPIKE_PERCENTILE + SPIKE_RELATIVE_ERROR)
                      & (F.col("upto") >= SPIKE_PERCENTILE - SPIKE_RELATIVE_ERROR)).alias("rank_within_error"))


def _stream_fanout(spark, sf_dir):
    """ST2: the second sink of the same batches, dashboard JSON, read back."""
    base = ST.rolling_stream(spark, sf_dir)
    back = files.read_json_ticks(spark, os.path.join(base, "dashboard"), DASHBOARD_SCHEMA)
    return report(back.drop(files.CORRUPT, "date", "hour"))


def _wide(m):
    """Metrics over two days: frames longer than a stored date."""
    return m.select("seq", "timestamp", "price", *[round6(c).alias(c) for c in (
        "log_return", "volatility_1h", "volatility_48h", "price_ma_48h")])


def _stream_stateful_late(spark, sf_dir):
    """ST6 with keyed state: final rows, and the late ticks of the quarantine without metrics."""
    base = ST.stateful_stream(spark, sf_dir, late=True)
    columns = ["seq", "symbol", *METRIC_COLS[1:]]
    final = _stream_out(spark, base).select(*columns, F.lit(None).cast("string").alias("reject_reason"))
    late = spark.read.parquet(os.path.join(base, "quarantine")).select(*columns, "reject_reason")
    return report(final.unionByName(late))


def _quotes(spark, sf_dir):
    return C.flatten_quotes(FX.quote_envelopes(FX.read_table(spark, sf_dir, "events")),
                            keep=("seq",))


def _candle_raw(spark, sf_dir):
    ensure_conf(spark)
    return C.parse_candle_responses(FX.candle_responses(ticks(spark, sf_dir)))


def _candles(spark, sf_dir):
    return C.normalize_candles(_candle_raw(spark, sf_dir))


def _json_ticks_roundtrip(spark, sf_dir):
    """S2 + S8: dashboard JSON lines written, then read with the schema."""
    path = scratch_path(spark, "dashboard")
    sinks.write_dashboard(metrics(spark, sf_dir), path)
    back = files.read_json_ticks(spark, path, DASHBOARD_SCHEMA).drop(files.CORRUPT)
    return report(back)


def _history(spark, sf_dir, **kw):
    """S7 + S3: date-partitioned history written, then scanned."""
    path = scratch_path(spark, "history")
    sinks.write_history(metrics(spark, sf_dir), path)
    return files.read_history(spark, path, **kw)


def _analysis_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "daily_stats")
    sinks.write_result(A.daily_stats(metrics(spark, sf_dir)), path)
    return report(spark.read.parquet(path))


def _candle_write_read(spark, sf_dir):
    path = scratch_path(spark, "candles")
    sinks.write_candles(keep(_candles(spark, sf_dir), "candles"), path)
    return report(spark.read.parquet(path).select(*CANDLE_COLUMNS))


def _volume_audit(spark, sf_dir):
    """Bytes of stored tick messages, in folders by hour of the day, against the minimum volume."""
    path = scratch_path(spark, "messages")
    t = ticks(spark, sf_dir)
    hours = t.select("seq", "hour_of_day")
    (FX.tick_json(t).join(hours, "seq").select("value", "hour_of_day").hint("rebalance", F.col("hour_of_day"))
       .write.partitionBy("hour_of_day").text(path))
    found = files.storage_volume(spark, path, HISTORY_MIN_GB)
    return found.select((F.col("files") >= 24).alias("all_hours"), F.col("total_bytes").cast("bigint").alias("total_bytes"),
                        "meets_minimum", round6("shortfall_gb").alias("shortfall_gb"))


def _history_merge(spark, sf_dir):
    """Ticks of the second poll's hours, and the first poll's candles where there are no ticks."""
    ensure_conf(spark)
    first, second = FX.landings(ticks(spark, sf_dir))
    symbol = F.concat(F.lit("S"), F.col("symbol").cast("string"))
    bulk = C.normalize_candles(C.parse_candle_responses(FX.candle_responses(first)))
    return C.history_merge(second.select("timestamp", "datetime", "date", symbol.alias("symbol"), "price"),
                           bulk.select("timestamp", "datetime", "date", "symbol", "interval", "price"),
                           {"hourly": 3600, "minute": 60})


def _dashboard(m: DataFrame) -> DataFrame:
    from volspark.schemas import DASHBOARD_COLUMNS
    return m.select(*DASHBOARD_COLUMNS)


def _stored_latest(spark, sf_dir, n: int = LATEST_N):
    """The newest stored dates that hold ``n`` rows."""
    path = scratch_path(spark, "history")
    sinks.write_history(metrics(spark, sf_dir), path)
    return files.read_latest(spark, path, n)


def _zoned_latest(spark, sf_dir, n: int = LATEST_N):
    """The files of a stored history that can hold one of the ``n`` latest rows, by its zone map."""
    path = scratch_path(spark, "history")
    sinks.write_zoned_history(metrics(spark, sf_dir), path, max_rows=10 * n)
    return files.read_latest(spark, path, n)


def _batch_job_summary(spark, sf_dir):
    """The batch job over a stored history: its summary row."""
    history = scratch_path(spark, "history")
    sinks.write_history(metrics(spark, sf_dir), history)
    out = jobs.batch_analysis(spark, history, scratch_path(spark, "analysis"))
    return report(spark.read.parquet(out["summary"]))


def _incremental(spark, sf_dir):
    """The incremental analysis, run when most dates are stored and again when all are.

    The last date of the first run grows with the second one: it is named as changed.
    """
    history, state, out = (scratch_path(spark, n) for n in ("history", "partials", "analysis"))
    whole = keep(metrics(spark, sf_dir), "all-metrics")
    cut = whole.agg(F.max("event_time").alias("t")).select((F.col("t") - F.expr("INTERVAL 60 HOURS")).alias("t")).scalar()
    early = whole.where(F.col("event_time") < cut)
    sinks.write_history(early, history)
    jobs.incremental_analysis(spark, history, state, out)
    seam = early.agg(F.max("date")).first()[0]
    sinks.write_history(whole.where(F.col("date") >= F.lit(seam)), history)
    return jobs.incremental_analysis(spark, history, state, out, changed=[seam])


def _landed(spark, ticks_df):
    """Candle responses of ticks as landed files, each of many series."""
    path = scratch_path(spark, "landed")
    FX.candle_responses(ticks_df).write.json(path)
    return path


def _backfill_job(spark, sf_dir):
    """Landed candle responses through the backfill job: the stored candle metrics."""
    ensure_conf(spark)
    return _backfilled(spark, [ticks(spark, sf_dir)])


def _backfill_incremental(spark, sf_dir):
    """Two landings that overlap, the second with the full candles of the first one's last hour."""
    ensure_conf(spark)
    return _backfilled(spark, FX.landings(ticks(spark, sf_dir)))


def _backfilled(spark, polls):
    base = scratch_path(spark, "backfill")
    for poll in polls:
        out = jobs.candle_backfill(spark, _landed(spark, poll), base)
    return report(spark.read.parquet(out["metrics"]).select(
        "symbol", "interval", "timestamp", "price", "log_return", "price_change_pct",
        "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h"))


def _candle_gaps(spark, sf_dir):
    """Missing and repeated hours of two landings together."""
    ensure_conf(spark)
    first, second = (C.normalize_candles(C.parse_candle_responses(FX.candle_responses(poll)))
                     for poll in FX.landings(ticks(spark, sf_dir)))
    return C.candle_gaps(first.unionByName(second), {"hourly": 3600, "minute": 60})


def _quote_job(spark, sf_dir):
    """Landed quote polls through the snapshot job: the tick messages, parsed."""
    landed = scratch_path(spark, "quotes")
    FX.quote_envelopes(FX.read_table(spark, sf_dir, "events")).write.json(landed)
    out = jobs.quote_snapshots(spark, landed, scratch_path(spark, "snapshots"))
    back = spark.read.text(out["ticks"])
    return C.parse_ticks(back, schema=stream_tick_schema({"symbol": "string"})).select(
        "seq", "timestamp", "datetime", "symbol", "price", "open24h", "supply")


def _sql_avg_price_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the named tables."""
    ensure_conf(spark)
    jobs.register_views(spark, ticks=ticks(spark, sf_dir), metrics=metrics(spark, sf_dir),
                        candles=_candles(spark, sf_dir))
    return spark.sql(
        "SELECT date, round(avg(price) + 1e-9, 6) + 0.0 AS avg_price, count(*) AS n "
        "FROM metrics GROUP BY date")
