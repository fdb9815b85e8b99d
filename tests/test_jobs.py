"""The batch-analysis job end to end on the smoke tables."""

from conftest import SF

from volspark import sinks
from volspark.operators.metrics import STANDIN_24H, tick_metrics
from volspark.plans.jobs import batch_analysis
from volspark.session import scratch_path
from volspark.sources.fixtures import ticks


def test_batch_analysis_job(spark):
    hist = scratch_path(spark, "hist")
    sinks.write_history(tick_metrics(ticks(spark, SF), extra=STANDIN_24H), hist)
    out = batch_analysis(spark, hist, scratch_path(spark, "results"))
    daily = spark.read.parquet(out["daily_stats"])
    assert daily.agg({"record_count": "sum"}).first()[0] == 1000
    assert spark.read.parquet(out["hourly_pattern"]).count() == 24
    n = spark.read.parquet(out["volatility_spikes"]).count()
    assert 0 < n <= 10          # strictly above the 99th percentile of 1000 rows
    summary = spark.read.parquet(out["summary"]).first()
    assert summary.total_records == 1000 and summary.spike_count == n and 0 <= summary.peak_hour <= 23


def test_stream_pipeline_processing_time_trigger(spark):
    """ST1: the production entry point with a processing-time trigger."""
    import os
    from volspark.plans.jobs import stream_pipeline
    root = scratch_path(spark, "pipe")
    src = os.path.join(root, "in")
    t = ticks(spark, SF).select("timestamp", "datetime", "price", "seq")
    t.write.json(src)
    q = stream_pipeline(spark, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                        json_dir=src, trigger_seconds=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.read.parquet(os.path.join(root, "out", "metrics"))
    assert got.count() == 1000
    want = tick_metrics(ticks(spark, SF))
    a = {r.seq: r.volatility_24h for r in got.collect()}
    b = {r.seq: r.volatility_24h for r in want.collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in b)
    assert q.lastProgress["observedMetrics"]["batch_rows"]["rows"] >= 0


def test_stream_pipeline_with_series_keys(spark):
    import os
    from volspark.plans.jobs import stream_pipeline
    root = scratch_path(spark, "keyed")
    t = ticks(spark, SF).selectExpr("timestamp", "datetime", "price", "seq", "concat('S', symbol) as symbol")
    t.write.json(os.path.join(root, "in"))
    q = stream_pipeline(spark, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                        json_dir=os.path.join(root, "in"), trigger_seconds=1, keys={"symbol": "string"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    a = {r.seq: r.volatility_24h for r in spark.read.parquet(os.path.join(root, "out", "metrics")).collect()}
    b = {r.seq: r.volatility_24h for r in tick_metrics(t, ("symbol",)).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in b)


def test_stream_pipeline_from_keyed_state(spark):
    import os
    from volspark.plans.jobs import stream_pipeline
    root = scratch_path(spark, "state")
    t = ticks(spark, SF).selectExpr("timestamp", "datetime", "price", "seq", "concat('S', symbol) as symbol")
    t.coalesce(1).write.json(os.path.join(root, "in"))
    with open(os.path.join(root, "in", "bad.json"), "w") as f:
        f.write("not json\n")
    q = stream_pipeline(spark, os.path.join(root, "out"), os.path.join(root, "ckpt"), json_dir=os.path.join(root, "in"),
                        trigger_seconds=1, keys={"symbol": "string"}, lateness=0)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    a = {r.seq: r.volatility_24h for r in spark.read.parquet(os.path.join(root, "out", "metrics")).collect()}
    b = {r.seq: r.volatility_24h for r in tick_metrics(t, ("symbol",)).collect()}
    assert a.keys() <= b.keys() and len(b) - len(a) <= 15       # at most the newest tick of a series is open
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)
    bad = spark.read.parquet(os.path.join(root, "out", "quarantine")).collect()
    assert [(r.reject_reason, r._corrupt_record) for r in bad] == [("null_timestamp", "not json")]
