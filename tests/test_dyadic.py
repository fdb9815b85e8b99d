"""The dyadic tree of bucket totals: few nodes, same results as the window form."""

import math
import random

import pytest
from pyspark.sql import functions as F

from volspark.operators import rolling as R
from volspark.operators.metrics import STANDIN_24H, tick_metrics, tick_metrics_window

COLS = ["seq", "log_return", "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h",
        "volume24h", "high24h", "low24h"]


@pytest.mark.parametrize("span", [2, 3, 24, 96, 1440])
def test_nodes_cover_the_middle_once(spark, span):
    rows = spark.range(-5, 3000, 37).select(F.col("id").alias("b"), R.dyadic_nodes(F.col("id"), span).alias("n")).collect()
    for b, nodes in rows:
        covered = [x for level, node in nodes for x in range(node << level, (node + 1) << level)]
        assert sorted(covered) == list(range(b - span + 1, b))
        assert len(nodes) <= max(1, 2 * math.log2(span))


def series(rng, n, burst):
    """Ticks of two weeks, ``burst`` of them within one hour, with ties and exact frame edges."""
    out = []
    for k in range(n):
        t = rng.randrange(5 * 86400, 5 * 86400 + 3600) if rng.random() < burst else 60 * rng.randrange(14 * 1440)
        out.append((t, round(rng.uniform(1, 9), 2), k, rng.choice(["a", "b"])))
    out += [(out[0][0] + 86400, 3.0, n, "a"), (out[0][0] + 3600, 4.0, n + 1, "a"), (None, 5.0, n + 2, "a")]
    return out


def by_seq(df):
    return {r.seq: tuple(r)[1:] for r in df.select(*COLS).collect()}


@pytest.mark.parametrize("width, burst, keys", [(60, 0.0, ("symbol",)), (60, 0.9, ()), (300, 0.5, ("symbol",)), (900, 0.2, ())])
def test_narrow_buckets_equal_the_window_form(spark, width, burst, keys):
    assert 86400 // width > R.DIRECT_SPAN
    rows = series(random.Random(width), 700, burst)
    df = spark.createDataFrame(rows, "timestamp long, price double, seq long, symbol string")
    got = tick_metrics(df, keys, extra=STANDIN_24H, bucket_seconds=width).where("timestamp is not null")
    want = tick_metrics_window(df.where("timestamp is not null"), keys, extra=STANDIN_24H)
    got, want = by_seq(got), by_seq(want)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-7, rel=1e-9) for k in want)


def test_a_burst_is_spread_over_its_buckets(spark):
    """90 % of the ticks in one hour: with buckets of a minute no bucket holds more than a few of them."""
    rows = series(random.Random(3), 4000, 0.9)
    df = spark.createDataFrame(rows, "timestamp long, price double, seq long, symbol string").where("timestamp is not null")
    sizes = R.add_series_bucket(df, [], "timestamp", 60, F.col("seq"), 1439).groupBy(R.BK).count()
    assert sizes.agg(F.max("count")).first()[0] < 0.05 * len(rows)


def test_a_bucket_asks_for_a_logarithm_of_rows(spark):
    """24 h frames at 60 s: the plan's requests, counted on a series without gaps."""
    df = spark.range(6 * 1440).select((F.col("id") * 60).alias("timestamp"))
    buckets = R.add_series_bucket(df, [], "timestamp", 60, F.lit(0), 1439).select(R.BK)
    most = buckets.select(F.size(R.dyadic_nodes(F.col(R.BK), 1440)).alias("n")).agg(F.max("n")).first()[0]
    assert most <= 2 * math.log2(1440)
