"""Quantile, analyses, dashboard series (A1-A7, P9, K*, C*, P14, P15)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from volspark.operators import analysis as A
from volspark.operators.clean import flatten_quotes
from volspark.operators import series as S
from volspark.operators.quantile import quantile_disc


def exact_disc(values, q):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    k = max(1, math.ceil(q * len(v)))
    return v[k - 1]


@pytest.mark.parametrize("n,q,seed", [(1, 0.99, 1), (7, 0.99, 2), (150, 0.99, 3),
                                      (1000, 0.5, 4), (2000, 0.01, 5), (500, 1.0, 6)])
def test_quantile_disc_exact(spark, n, q, seed):
    rnd = random.Random(seed)
    vals = [rnd.choice([None, 0.0, 1.0, round(rnd.uniform(0, 10), 3)]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = quantile_disc(df, "x", q).first()["quantile"]
    assert got == exact_disc(vals, q)


def test_quantile_hot_value_and_empty(spark):
    vals = [5.0] * 3000 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert quantile_disc(df, "x", 0.99).first()["quantile"] == exact_disc(vals, 0.99)
    empty = spark.createDataFrame([], "x double")
    assert quantile_disc(empty, "x", 0.99).first()["quantile"] is None


def metrics_frame(spark):
    data = [("2024-01-01", 0, 10.0, 0.1, 0.2, 100.0), ("2024-01-01", 3600, 12.0, 0.3, 0.4, 50.0),
            ("2024-01-02", 86400 + 7200, 8.0, 0.5, 0.9, 10.0),
            ("2024-01-02", 86400 + 7300, 9.0, 0.5, None, 20.0)]
    df = spark.createDataFrame(
        data, "d string, timestamp long, price double, volatility_1h double, "
              "volatility_24h double, volume24h double")
    return (df.withColumn("date", F.to_date("d")).drop("d")
              .withColumn("event_time", F.timestamp_seconds("timestamp"))
              .withColumn("datetime", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
              .withColumn("seq", F.col("timestamp"))
              .withColumn("high24h", F.col("price")).withColumn("low24h", F.col("price")))


def test_daily_stats(spark):
    got = {r.date.isoformat(): r for r in A.daily_stats(metrics_frame(spark)).collect()}
    d1 = got["2024-01-01"]
    assert d1.avg_price == 11.0 and d1.max_price == 12.0 and d1.record_count == 2
    assert math.isclose(d1.std_vol, math.sqrt(0.02))
    assert got["2024-01-02"].std_vol is None and got["2024-01-02"].total_volume == 30.0


def test_hourly_and_peak(spark):
    df = metrics_frame(spark)
    hp = {r.hour_of_day: r for r in A.hourly_pattern(df).collect()}
    assert set(hp) == {0, 1, 2} and hp[2].record_count == 2
    pk = A.peak_hour(df).first()
    assert pk.hour_of_day == 2 and pk.avg_vol_1h == 0.5


def test_spikes_strictly_above_and_empty(spark):
    df = metrics_frame(spark)
    sp = A.volatility_spikes(df, 0.5)
    assert [r.volatility_24h for r in sp.collect()] == [0.9]
    assert sp.columns == A.SPIKE_COLUMNS
    empty = df.filter(F.lit(False))
    assert A.volatility_spikes(empty).count() == 0
    summ = A.analysis_summary(df, 0.5).first()
    assert (summ.total_records, summ.total_days, summ.spike_count) == (4, 2, 1)


def test_require_columns(spark):
    with pytest.raises(ValueError, match="volatility_1h"):
        A.require_columns(spark.range(1), ["id", "volatility_1h"])


def test_candles(spark):
    data = [(0, 1, 5.0), (10, 2, 7.0), (10, 3, 6.0), (59, 4, 4.0), (60, 5, 9.0)]
    df = spark.createDataFrame(data, "timestamp long, seq long, price double").withColumn(
        "symbol", F.lit(1))
    c = {r.time: r for r in A.candles(df, 60).collect()}
    assert (c[0].open, c[0].high, c[0].low, c[0].close, c[0].volumefrom) == (5.0, 7.0, 4.0, 4.0, 4.0)
    assert c[60].open == 9.0 and c[60].volumeto == 9.0


def test_latest_and_kpis(spark):
    df = metrics_frame(spark)
    assert [r.timestamp for r in S.latest_n(df, 2).collect()] == [86400 + 7300, 86400 + 7200]
    plan = S.latest_n(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    k = S.latest_kpis(df.withColumn("price", F.lit(12345.678))).first()
    assert k.current_price == "$12,345.68"
    assert k.current_volatility == "N/A" and k.current_volume == "$20"
    assert k.last_update == "1970-01-02 02:01:40"
    av = S.series_availability(df.drop("price_ma_1h")).first()
    assert av.has_price_ma_1h is False and av.has_volatility_24h is True


def test_feed_health(spark):
    """A message is an envelope that yields a tick; everything else is a failed poll."""
    bodies = ['{"RAW":{"X":{"USD":{"PRICE":1.5}}}}', "not json", "{}", '{"Response":"Error","Message":"limit"}',
              '{"RAW":{}}', '{"RAW":{"X":{}}}', None, '{"Response":"Success","RAW":{"X":{"USD":{}}}}']
    polls = spark.createDataFrame([(b, i) for i, b in enumerate(bodies)], "body string, timestamp long")
    r = A.feed_health(polls).first()
    assert (r.messages, r.errors, r.success_rate_pct) == (2, 6, 25.0)
    assert flatten_quotes(polls).count() == 2
    r = A.feed_health(polls.where("false")).first()
    assert (r.messages, r.errors, r.success_rate_pct) == (0, 0, None)
