"""Keyed-state streaming: frames over buckets, lateness, quarantine, bounded state, replay."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from volspark.operators.clean import enrich_ticks
from volspark.operators.metrics import STANDIN_24H, tick_metrics
from volspark.session import scratch_path
from volspark.sources.files import stream_json_ticks
from volspark.schemas import stream_tick_schema
from volspark.streaming import stateful as ST

COLS = ["log_return", "price_change_pct", "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h",
        "volume24h", "high24h", "low24h"]


@pytest.mark.parametrize("width, seconds", [(3600, (3600, 7200, 86400)), (60, (60, 600))])
def test_frames_equal_brute_force(width, seconds):
    rng = random.Random(width)
    t = np.sort(np.array([rng.choice([rng.randrange(4 * seconds[-1]), width * rng.randrange(90)]) for _ in range(500)]))
    r, p = (np.array([rng.uniform(-1, 1) for _ in t]) for _ in range(2))
    parts = tuple((kind, column) for kind in ("count", "sum", "sumsq", "max", "min") for column in ST.COLUMNS)
    kept, totals, got = {}, {}, []
    cuts = [0, *sorted(np.searchsorted(t, rng.choice(t)) for _ in range(6)), len(t)]
    for lo, hi in zip(cuts, cuts[1:]):                      # cuts never split a second
        values, changed = ST.frame_values(lambda b: kept.get(b, ST.NOTHING), totals, (t[lo:hi], r[lo:hi], p[lo:hi]),
                                          width, parts, seconds)
        got.append(values)
        kept |= changed
        oldest = t[hi - 1] // width - seconds[-1] // width if hi else 0
        for b in [b for b in totals if b < oldest]:
            del kept[b], totals[b]
    got = np.concatenate(got)
    for i in range(len(t)):
        for f, s in enumerate(seconds):
            inside = (t >= t[i] - s) & (t <= t[i])
            want = []
            for kind, column in parts:
                v = (r if column == "log_return" else p)[inside]
                want.append({"count": len(v), "sum": v.sum(), "sumsq": (v * v).sum(), "max": v.max(), "min": v.min()}[kind])
            assert np.allclose(got[i, f], want)


@pytest.fixture
def few_partitions(spark):
    own = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", own)


class Feed:
    """Ticks that arrive file by file; every arrival resumes the query."""

    def __init__(self, spark, **kw):
        self.spark, self.kw = spark, kw
        self.root = scratch_path(spark, "feed")
        self.base, self.checkpoint = (os.path.join(self.root, p) for p in ("out", "ckpt"))
        self.sink = ST.StatefulMetricsSink(self.base)

    def arrive(self, rows):
        rows = self.spark.createDataFrame(rows, "timestamp long, price double, seq long, symbol string")
        rows.coalesce(1).write.mode("append").json(os.path.join(self.root, "in"))
        stream = stream_json_ticks(self.spark, os.path.join(self.root, "in"), stream_tick_schema({"symbol": "string"}))
        found = ST.stateful_metrics(stream, ("symbol",), extra=STANDIN_24H, **self.kw)
        q = ST.start_stateful(found, self.sink, self.checkpoint, available_now=True)
        q.awaitTermination()
        assert q.exception() is None

    def metrics(self):
        rows = self.spark.read.parquet(os.path.join(self.base, "metrics")).select("symbol", "seq", *COLS).collect()
        assert len(rows) == len({r[:2] for r in rows})
        return {tuple(r[:2]): [round(x, 8) for x in r[2:]] for r in rows}

    def quarantine(self):
        rows = self.spark.read.parquet(os.path.join(self.base, "quarantine")).select(
            "symbol", "seq", "reject_reason").collect()
        return {(r.symbol, r.seq): r.reject_reason for r in rows}

    def want(self, rows):
        df = self.spark.createDataFrame(rows, "timestamp long, price double, seq long, symbol string")
        m = tick_metrics(enrich_ticks(df), ("symbol",), extra=STANDIN_24H).select("symbol", "seq", *COLS)
        return {tuple(r[:2]): [round(x, 8) for x in r[2:]] for r in m.collect()}


def hourly(symbol, first, n, step=1700):
    return [(first + k * step, 10.0 + (k * 7) % 5, k, symbol) for k in range(n)]


def test_batches_give_the_batch_metrics_and_late_ticks_go_to_the_quarantine(spark, few_partitions):
    feed = Feed(spark)
    a, b = hourly("a", 1_700_000_000, 120), hourly("b", 1_699_000_000, 90)       # b runs days behind a
    feed.arrive(a[:50] + b[:40])
    late = [(a[20][0], 99.0, 900, "a"), (a[49][0], 99.0, 901, "a")]
    feed.arrive(a[50:51] + b[40:] + late + [a[30]])              # a[30] is sent twice
    feed.arrive(a[51:])
    assert feed.metrics() == feed.want(a + b)
    assert feed.quarantine() == {("a", 900): ST.LATE, ("a", 901): ST.LATE, ("a", 30): ST.LATE}
    assert sum(n for n, _ in feed.sink.counts.values()) == len(a + b)


def test_lateness_orders_ticks_and_joins_a_second_over_batches(spark, few_partitions):
    feed = Feed(spark, lateness=4000)
    rows = hourly("a", 1_700_000_000, 60)
    rows += [(t, p + 3, s + 100, k) for t, p, s, k in rows[::5]]             # peers of the same second
    mixed = sorted(rows, key=lambda r: (r[0] // 3400, r[2] % 7))            # out of order within 3400 s
    feed.arrive(mixed[:30])
    feed.arrive(mixed[30:])
    end = (rows[59][0] + 4001, 20.0, 999, "a")
    feed.arrive([end])                                                      # the last 4000 s are still open
    got = feed.metrics()
    want = feed.want([*rows, end])
    open_ = {("a", r[2]) for r in [*rows, end] if r[0] > end[0] - 4000}
    assert ("a", 999) in open_ and set(want) - set(got) == open_
    assert all(got[k] == want[k] for k in got)
    assert not os.path.exists(os.path.join(feed.base, "quarantine"))


def test_rejected_ticks_do_not_move_the_watermark(spark, few_partitions):
    feed = Feed(spark)
    rows = hourly("a", 1_700_000_000, 20)
    bad = [(None, 1.0, 700, "a"), (1_700_000_001, None, 701, "a"), (1_700_000_002, -1.0, 702, None),
           (4_000_000_000, 1.0, 703, "a"), (9_000_000_000_000, 1.0, 704, "b")]
    feed.arrive(rows[:10] + bad)
    feed.arrive(rows[10:] + [(1_600_000_000, 5.0, 0, None)])        # a series without a name is one too
    assert feed.metrics() == feed.want(rows + [(1_600_000_000, 5.0, 0, None)])
    assert feed.quarantine() == {
        ("a", 700): "null_timestamp", ("a", 701): "null_price", (None, 702): "non_positive_price",
        ("a", 703): ST.AHEAD, ("b", 704): "timestamp_out_of_range"}


def test_state_does_not_grow_with_history(spark, few_partitions):
    feed = Feed(spark)
    rows = hourly("a", 1_700_000_000, 400)                                  # 189 hours
    sizes = []
    for at in (0, 200):
        feed.arrive(rows[at:at + 200])
        state = spark.read.format("statestore").option("stateVarName", "ticks").load(feed.checkpoint)
        sizes.append(state.count())
    assert max(sizes) <= 25
    assert feed.metrics() == feed.want(rows)


def test_a_replayed_batch_replaces_itself(spark):
    base = scratch_path(spark, "replay")
    sink = ST.StatefulMetricsSink(base)
    rows = enrich_ticks(spark.createDataFrame(
        [(0, 1.0, None), (5, 2.0, None), (1, 3.0, ST.LATE)], "timestamp long, price double, reject_reason string"))
    for batch in (0, 0, 1):
        sink(rows, batch)
    sink(rows.where("false"), 2)
    assert spark.read.parquet(os.path.join(base, "metrics")).count() == 4
    assert spark.read.parquet(os.path.join(base, "quarantine")).count() == 2
    assert sink.counts == {0: (2, 1), 1: (2, 1), 2: (0, 0)}


def test_the_sessions_state_store_is_left_alone(spark, few_partitions):
    own = spark.conf.get(ST.PROVIDER)
    feed = Feed(spark)
    feed.arrive(hourly("a", 1_700_000_000, 3))
    assert spark.conf.get(ST.PROVIDER) == own
