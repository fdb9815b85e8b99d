"""Rolling metrics: null/edge rules (N1-N7) and engine == literal window form."""

import math
import random

import pytest

from volspark.operators.metrics import STANDIN_24H, tick_metrics, tick_metrics_window

METRICS = ["log_return", "price_change_pct", "volatility_1h", "volatility_24h",
           "price_ma_1h", "price_ma_24h"]


def frame(spark, data, cols="timestamp long, price double"):
    df = spark.createDataFrame(data, cols)
    if "seq" not in df.columns:
        from pyspark.sql import functions as F
        df = df.withColumn("seq", F.monotonically_increasing_id())
    return df


def by_time(df, col):
    return [r[col] for r in df.orderBy("timestamp", "seq").collect()]


def close(a, b, tol=1e-6):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(b))


def test_null_rules(spark):
    data = [(0, 10.0), (10, 0.0), (20, 11.0), (30, None), (40, 12.0), (50, -1.0),
            (4000, 12.0), (7600, 13.0)]
    m = tick_metrics(frame(spark, data))
    rets = by_time(m, "log_return")
    expect = [0.0, None, 0.0, None, 0.0, None, 0.0, 0.080043]
    assert all(close(a, b) for a, b in zip(rets, expect)), rets
    v1 = by_time(m, "volatility_1h")
    assert v1[:-1] == [0.0] * 7 and close(v1[-1], 0.056599)
    assert close(by_time(m, "volatility_24h")[-1], 0.035796)
    ma = by_time(m, "price_ma_1h")
    assert all(close(a, b) for a, b in zip(ma, [10, 5, 7, 7, 8.25, 6.4, 12, 12.5])), ma
    pct = by_time(m, "price_change_pct")
    assert pct[1] == -100.0 and pct[3] is None and pct[0] == 0.0


def test_empty_and_single(spark):
    empty = frame(spark, [], "timestamp long, price double")
    assert tick_metrics(empty).count() == 0
    one = tick_metrics(frame(spark, [(100, 5.0)])).collect()[0]
    assert one.log_return == 0.0 and one.volatility_1h == 0.0 and one.volatility_24h == 0.0
    assert one.price_ma_1h == 5.0 and one.price_ma_24h == 5.0


def test_ties_use_seq_and_range_includes_peers(spark):
    data = [(100, 2.0, 2), (100, 1.0, 1), (200, 4.0, 3)]
    m = tick_metrics(spark.createDataFrame(data, "timestamp long, price double, seq long"))
    got = {r.seq: r for r in m.collect()}
    assert got[1].log_return == 0.0
    assert close(got[2].log_return, math.log(2.0))
    # the frame of seq 1 holds its peer seq 2 (same timestamp)
    assert close(got[1].price_ma_1h, 1.5) and close(got[2].price_ma_1h, 1.5)


def test_frame_edges_inclusive(spark):
    data = [(0, 1.0), (3600, 2.0), (3601, 4.0), (86400, 8.0), (86401, 16.0), (90001, 32.0)]
    m = tick_metrics(frame(spark, data))
    ma1 = by_time(m, "price_ma_1h")
    assert close(ma1[1], 1.5)          # t=3600 sees t=0 (exact edge)
    assert close(ma1[2], 3.0)          # t=3601 no longer sees t=0
    ma24 = by_time(m, "price_ma_24h")
    assert close(ma24[3], (1 + 2 + 4 + 8) / 4)    # t=86400 sees t=0
    assert close(ma24[4], (2 + 4 + 8 + 16) / 4)   # t=86401 does not


def test_long_gap_carries_previous_price(spark):
    data = [(0, 10.0), (100, 20.0), (3 * 86400 + 5, 40.0), (3 * 86400 + 50, 10.0)]
    m = tick_metrics(frame(spark, data))
    rets = by_time(m, "log_return")
    assert close(rets[2], math.log(2.0)) and close(rets[3], math.log(0.25))
    assert by_time(m, "volatility_24h")[2] == 0.0


def _random_series(spark, n, seed, keyed):
    rnd = random.Random(seed)
    t, data = 0, []
    for i in range(n):
        step = rnd.choice([0, 1, 60, 600, 3600, 3599, 86400, 86401, 3 * 86400, rnd.randint(1, 9000)])
        t += step
        p = rnd.choice([None, 0.0, -1.0] + [round(rnd.uniform(1, 500), 2)] * 20)
        data.append((t, p, i, rnd.randint(1, 4) if keyed else 0))
    return spark.createDataFrame(data, "timestamp long, price double, seq long, symbol long")


@pytest.mark.parametrize("seed,keyed,width", [(1, False, None), (2, True, None),
                                              (3, False, 900), (4, True, 1800)])
def test_engine_equals_window_form(spark, seed, keyed, width):
    df = _random_series(spark, 400, seed, keyed)
    keys = ("symbol",) if keyed else ()
    a = {r.seq: r for r in tick_metrics(df, keys, extra=STANDIN_24H, bucket_seconds=width).collect()}
    b = {r.seq: r for r in tick_metrics_window(df, keys, extra=STANDIN_24H).collect()}
    assert a.keys() == b.keys()
    for k, rb in b.items():
        for c in METRICS + list(STANDIN_24H):
            assert close(a[k][c], rb[c], 1e-9), (seed, k, c, a[k][c], rb[c])


def test_bucket_must_divide_frames(spark):
    with pytest.raises(ValueError):
        tick_metrics(frame(spark, [(0, 1.0)]), bucket_seconds=7000)


def test_no_single_partition_exchange_on_rows(spark):
    """The row-level windows are partitioned by bucket; only the small
    per-bucket tables may use a single partition."""
    df = _random_series(spark, 50, 9, False)
    plan = tick_metrics(df)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "lag(price" in line:
            assert "windowspecdefinition(_b" in line, line
    assert "RangeFrame, -86400" not in plan     # no sliding 24h frame over rows


def test_untimed_rows_are_kept(spark):
    df = spark.createDataFrame([(0, 1.0, 1), (None, 2.0, 2), (60, 2.0, 3)],
                               "timestamp long, price double, seq long")
    got = {r.seq: r for r in tick_metrics(df).collect()}
    assert set(got) == {1, 2, 3}
    assert got[2].log_return is None and got[2].volatility_24h is None
    assert abs(got[3].log_return - math.log(2.0)) < 1e-12
