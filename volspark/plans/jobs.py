"""End-to-end jobs: batch analysis, candle backfill, quote snapshots, the streaming pipeline.

All take the caller's session; none sets a master or memory (those belong
to the launcher).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark import sinks
from volspark.operators import analysis as A
from volspark.operators import partials as P
from volspark.operators.clean import (
    flatten_quotes, good, latest_candles, normalize_candles, parse_candle_responses, parse_ticks,
    quality_check, quarantined,
)
from volspark.operators.metrics import candle_metrics
from volspark.schemas import ANALYSIS_REQUIRED, CANDLE_COLUMNS, HISTORY_MIN_GB, SPIKE_PERCENTILE, stream_tick_schema
from volspark.session import ensure_conf, keep
from volspark.sources.files import (
    CORRUPT, path_exists, read_candle_responses, read_history, read_quotes, storage_volume,
    stored_dates, stream_json_ticks,
)
from volspark.sources.kafka import read_ticks_stream, to_kafka_value, write_ticks
from volspark.streaming.stateful import StatefulMetricsSink, start_stateful, stateful_metrics
from volspark.streaming.stream import RollingMetricsSink, start


def batch_analysis(spark: SparkSession, history_path: str, out_dir: str, *,
                   exact_threshold: bool = True, ordered: bool = False,
                   date_from=None, date_to=None) -> dict:
    """Daily statistics, hour-of-day pattern, peak hour, spikes and summary of the history.

    Every analysis scans its own columns of the history (only the spike columns
    are needed twice). The summary row has record, day and spike counts, the
    threshold and the peak hour. Results are overwritten as a whole; returns
    the output paths.
    """
    ensure_conf(spark)
    hist = read_history(spark, history_path, date_from, date_to)
    A.require_columns(hist, ANALYSIS_REQUIRED)
    out = {name: os.path.join(out_dir, name) for name in
           ("daily_stats", "hourly_pattern", "peak_hour", "volatility_spikes", "summary")}
    sinks.write_result(A.daily_stats(hist, ordered), out["daily_stats"])
    sinks.write_result(A.hourly_pattern(hist, ordered=ordered), out["hourly_pattern"])
    sinks.write_result(A.peak_hour(hist), out["peak_hour"])
    # found once, read by the spikes and the summary
    found = keep(A.spike_threshold(hist, exact=exact_threshold), "threshold")
    sinks.write_result(A.volatility_spikes(hist, ordered=ordered, found=found), out["volatility_spikes"])
    peak = spark.read.parquet(out["peak_hour"])
    summary = A.analysis_summary(hist, found=found).select(
        "*", found.select("quantile").scalar().alias("threshold"), peak.select("hour_of_day").scalar().alias("peak_hour"))
    sinks.write_result(summary, out["summary"])
    return out


def incremental_analysis(spark: SparkSession, history_path: str, state_path: str, out_dir: str, *,
                         changed: list | None = None, q: float = SPIKE_PERCENTILE) -> dict:
    """Daily statistics, hour-of-day pattern, spikes and threshold, reading only new dates and the spike band.

    ``state_path`` holds the day partials. ``changed``: dates that were written since
    the last run (late ticks, backfills); dates that the state lacks are always
    added, those that left the history are not looked for. Results are overwritten
    as a whole; returns the output paths.
    """
    ensure_conf(spark)
    out = {name: os.path.join(out_dir, name) for name in
           ("daily_stats", "hourly_pattern", "threshold", "volatility_spikes")}
    known = set(stored_dates(spark, state_path)) if path_exists(spark, state_path) else set()
    fresh = sorted((set(stored_dates(spark, history_path)) - known) | set(changed or []))
    hist = read_history(spark, history_path)
    if fresh:
        sinks.write_history(P.day_partials(hist.where(F.col("date").isin(fresh))), state_path)
    partials = spark.read.parquet(state_path)
    sinks.write_result(P.daily_stats(partials), out["daily_stats"])
    sinks.write_result(P.hourly_pattern(partials), out["hourly_pattern"])
    dated = hist.where(F.col("date").isNotNull())
    sinks.write_result(P.spike_threshold(dated, partials, q), out["threshold"])
    found = spark.read.parquet(out["threshold"])
    top = found.first().quantile
    # spikes are looked for in dates that have any
    dates = [r.date for r in partials.groupBy("date").agg(F.max("vol_max").alias("m")).where(F.col("m") > top).collect()
             ] if top is not None else []
    sinks.write_result(A.volatility_spikes(dated.where(F.col("date").isin(dates)), found=found), out["volatility_spikes"])
    return out


SERIES = sinks.SERIES
LONGEST_FRAME = 86400           # seconds of candle_metrics


def candle_backfill(spark: SparkSession, landed_path: str, out_dir: str, *,
                    min_gb: float = HISTORY_MIN_GB) -> dict:
    """Landed candle responses -> stored candles and their metrics -> volume audit.

    Every run adds what its landing holds: candles are upserted by (symbol,
    interval, timestamp), and a candle that was polled again is replaced (within a
    landing the newest file wins). Metrics are recomputed per series from its first
    new or changed candle on; series without a change are not written. The tables are
    put together in the scratch folder before a partition is replaced, and changes are
    found against the stored metrics, so a run that was cut off can be repeated.

    Returns the paths of ``candles`` and ``metrics`` (both partitioned by symbol
    and interval, or by series bucket, see ``sinks.write_candles``) and of the one-row
    ``audit``.
    """
    ensure_conf(spark)
    out = {name: os.path.join(out_dir, name) for name in ("candles", "metrics", "audit")}
    raw = parse_candle_responses(read_candle_responses(spark, landed_path), keep=(*SERIES, "polled_at"))
    landed = keep(latest_candles(normalize_candles(raw, keep=("polled_at",)), "polled_at"), "landed-candles")
    stored = _stored_series(spark, out["candles"], landed)
    candles = landed
    if stored is not None:
        both = stored.withColumn("run", F.lit(0)).unionByName(landed.withColumn("run", F.lit(1)))
        candles = keep(latest_candles(both, "run"), "candles")
    sinks.write_candles(candles, out["candles"])
    _refresh_metrics(spark, candles, out["metrics"])
    sinks.write_result(storage_volume(spark, out["candles"], min_gb), out["audit"])
    return out


def _stored_series(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The stored rows of the series that ``like`` has; None before the first run."""
    if not path_exists(spark, path):
        return None
    stored = spark.read.parquet(path).drop(sinks.SERIES_BUCKET)
    stored = stored.withColumns({c: F.col(c).cast("string") for c in SERIES})     # folder names
    return stored.join(like.select(*SERIES).distinct(), SERIES, "left_semi")


def _refresh_metrics(spark: SparkSession, candles: DataFrame, path: str) -> None:
    """Bring the stored metrics of the series of ``candles`` up to date."""
    stored = _stored_series(spark, path, candles)
    changed = candles.select(*CANDLE_COLUMNS)
    if stored is not None:
        changed = changed.subtract(stored.select(*CANDLE_COLUMNS))
    since = keep(changed.groupBy(*SERIES).agg(F.min("timestamp").alias("since")), "changed-series")
    rows = candles.join(since, SERIES)
    near = F.col("timestamp") >= F.col("since") - LONGEST_FRAME
    # the candle before the look-back gives its first return
    carry = (rows.where(~near).groupBy(*SERIES)
             .agg(F.max_by(F.struct(*[c for c in rows.columns if c not in SERIES]), "timestamp").alias("_c"))
             .select(*SERIES, "_c.*"))
    fresh = (candle_metrics(rows.where(near).unionByName(carry.select(*rows.columns)))
             .where("timestamp >= since").drop("since"))
    if stored is not None:
        older = stored.join(since, SERIES).where("timestamp < since").drop("since")
        fresh = fresh.unionByName(older)
    sinks.write_candles(keep(fresh, "candle-metrics"), path)


def quote_snapshots(spark: SparkSession, quotes_path: str, out_dir: str, *,
                    kafka_bootstrap: str | None = None, topic: str | None = None) -> dict:
    """Landed quote polls -> ticks -> quality check -> tick sink (Kafka, else JSON lines).

    Rejected ticks go to ``quarantine``. Returns the output paths.
    """
    ensure_conf(spark)
    out = {name: os.path.join(out_dir, name) for name in ("ticks", "quarantine")}
    # both outputs read it: parsed once
    checked = keep(quality_check(flatten_quotes(read_quotes(spark, quotes_path), keep=("seq",))), "checked-quotes")
    accepted = good(checked)
    if kafka_bootstrap:
        write_ticks(accepted, kafka_bootstrap, topic)
    else:
        to_kafka_value(accepted).write.mode("overwrite").text(out["ticks"])
    quarantined(checked).write.mode("overwrite").parquet(out["quarantine"])
    return out


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Name tables for ad-hoc SQL, e.g. ``ticks=``, ``metrics=`` and ``candles=``."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def stream_pipeline(spark: SparkSession, base: str, checkpoint: str, *,
                    kafka_bootstrap: str | None = None, topic: str | None = None,
                    json_dir: str | None = None, trigger_seconds: int = 30,
                    keys: dict[str, str] | None = None, slot_hours: int = 24,
                    lateness: int | None = None):
    """Ticks (Kafka or a JSON directory) -> rolling metrics -> history +
    dashboard sinks, one query, one trigger, one checkpoint.

    ``keys``: the fields that name a series, with their types, e.g.
    ``{"symbol": "string"}``; they are read from each message. Rejected
    messages keep their text in the quarantine.

    ``slot_hours`` is the width of a stored slot of ``RollingMetricsSink``. With
    ``lateness`` (seconds) the metrics come from keyed state instead, for feeds
    that are ordered within each series up to it.
    """
    ensure_conf(spark)
    schema = stream_tick_schema(keys)
    if kafka_bootstrap:
        raw = read_ticks_stream(spark, kafka_bootstrap, topic).withColumnRenamed("value", CORRUPT)
        fields = schema[[f for f in schema.fieldNames() if f != "seq"]]
        ticks = parse_ticks(raw, CORRUPT, keep=("seq", CORRUPT), schema=fields)
    else:
        ticks = stream_json_ticks(spark, json_dir, schema)
    if lateness is not None:
        found = stateful_metrics(ticks, tuple(keys or ()), lateness=lateness)
        return start_stateful(found, StatefulMetricsSink(base), checkpoint, trigger_seconds=trigger_seconds)
    return start(ticks, RollingMetricsSink(base, keys=tuple(keys or ()), slot_hours=slot_hours), checkpoint,
                 trigger_seconds=trigger_seconds)
