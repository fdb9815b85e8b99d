"""Bursts cut into blocks of ranks: blocks stay small, results equal the window form."""

import random

import pytest
from pyspark.sql import functions as F

from volspark.operators import rolling as R
from volspark.operators.metrics import STANDIN_24H, tick_metrics, tick_metrics_window

SCHEMA = "timestamp long, price double, seq long, symbol string"
COLS = ["seq", "log_return", "price_change_pct", "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h",
        "volume24h", "high24h", "low24h"]


def ticks(n, hour, second, seed=5):
    """Ticks of three days; a share of them in one hour, another within one second of it."""
    rng = random.Random(seed)
    at = 2 * 86400
    out = []
    for k in range(n):
        x = rng.random()
        t = at + 7 if x < second else at + rng.randrange(3600) if x < second + hour else rng.randrange(3 * 86400)
        price = rng.choice([None, 0.0, round(rng.uniform(1, 9), 2)]) if k % 50 == 0 else round(rng.uniform(1, 9), 2)
        out.append((t, price, k, rng.choice(["a", "b", None])))
    rng.shuffle(out)
    return out + [(at - 86400 + 7, 2.0, n, "a"), (at + 86400 + 7, 3.0, n + 1, "a"), (at + 3600 + 7, 4.0, n + 2, "b")]


def by_seq(df):
    return {r.seq: tuple(r)[1:] for r in df.select(*COLS).collect()}


@pytest.mark.parametrize("hour, second, keys, block_rows", [
    (0.9, 0.0, (), 40), (0.3, 0.6, ("symbol",), 40), (0.0, 0.9, (), 100), (0.5, 0.4, (), 1), (0.2, 0.2, ("symbol",), 10 ** 6)])
def test_blocks_equal_the_window_form(spark, hour, second, keys, block_rows):
    df = spark.createDataFrame(ticks(600, hour, second), SCHEMA)
    got = by_seq(tick_metrics(df, keys, extra=STANDIN_24H, block_rows=block_rows))
    want = by_seq(tick_metrics_window(df, keys, extra=STANDIN_24H))
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(got[k], want[k]):
            assert a is b is None or a == pytest.approx(b, abs=1e-7, rel=1e-9)


@pytest.mark.parametrize("hour, second", [(0.9, 0.0), (0.1, 0.8)])
def test_no_block_holds_more_than_twice_its_share(spark, hour, second):
    df = spark.createDataFrame(ticks(40000, hour, second), SCHEMA)
    rows = R.add_blocks(R.add_series_bucket(df, [], "timestamp", 3600, F.col("seq"), 23), "timestamp", "seq", 2000)
    blocks = rows.groupBy(R.BK, R.BLK).agg(
        F.count("*").alias("n"), F.min(F.struct("timestamp", "seq")).alias("low"),
        F.max(F.struct("timestamp", "seq")).alias("high")).orderBy(R.BK, R.BLK).collect()
    assert sum(b.n for b in blocks) == 40003 and len(blocks) > 18
    assert max(b.n for b in blocks) <= 2 * 2000
    assert all(a.high < b.low for a, b in zip(blocks, blocks[1:]))


def test_rows_without_a_time_ties_and_empty_tables(spark):
    rows = [(None, 1.0, k, "a") for k in range(50)] + [(5, 2.0, 7, "a")] * 30 + [(6, 3.0, 8, "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = tick_metrics(df, block_rows=4)
    assert got.count() == len(rows)
    assert got.where("timestamp is null and price_ma_1h is not null").count() == 0
    last = got.where("timestamp = 6").first()
    assert last.price_ma_1h == pytest.approx(63 / 31) and last.price_change_pct == pytest.approx(50.0)
    assert got.columns == tick_metrics(df).columns
    assert tick_metrics(df.limit(0), block_rows=4).collect() == []
    with pytest.raises(ValueError):
        R.add_blocks(df, "timestamp", "seq", 0)
