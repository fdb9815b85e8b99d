"""Keyed-state streaming, many series: worked on by slot, kept by page (F1, F2)."""

import os
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from volspark.operators.metrics import STANDIN_24H
from volspark.schemas import stream_tick_schema
from volspark.sources.files import stream_json_ticks
from volspark.streaming import stateful as ST
from test_stateful import Feed, few_partitions, hourly  # noqa: F401

PLAN = ST.Plan(("order_seq",), (1, 24), tuple(STANDIN_24H.items()), 0)


class Store:
    """State of one slot; counts the requests and the bytes written."""

    def __init__(self):
        self.values, self.maps, self.timers, self.calls, self.written = {}, {}, set(), Counter(), Counter()

    def getValueState(self, name, schema):
        return Variable(self, self.values.setdefault(name, {}))

    def getMapState(self, name, key, value):
        return Variable(self, self.maps.setdefault(name, {}))

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.add(at)


class Variable:
    def __init__(self, store, kept):
        self.store, self.kept = store, kept

    def exists(self):
        self.store.calls["exists"] += 1
        return () in self.kept

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def getValue(self, key):
        self.store.calls["get"] += 1
        return self.kept[key]

    def updateValue(self, key, value):
        self.store.calls["update"] += 1
        self.store.written[key] += 1
        self.kept[key] = value

    def removeKey(self, key):
        self.store.calls["remove"] += 1
        del self.kept[key]

    def iterator(self):
        self.store.calls["iterator"] += 1
        return iter(self.kept.items())


class Now:
    def __init__(self, second):
        self.second = second

    def getCurrentWatermarkInMs(self):
        return self.second * 1000


class Slot:
    """A processor over batches, each in a task of its own, as Spark calls it."""

    def __init__(self, plan=PLAN):
        self.plan, self.store, self.rows = plan, Store(), []

    def _made(self):
        processor = ST.SeriesMetrics(self.plan, 3600)
        processor.init(self.store)
        return processor

    def batch(self, ticks, watermark=0):
        """``ticks``: (series, page, second, price)."""
        processor = self._made()
        if ticks:
            rows = pd.DataFrame([(s, page, t, k, p, None, f"{s} {t} {p}") for k, (s, page, t, p) in enumerate(ticks)],
                                columns=["tick_series", "tick_page", "tick_t", "order_seq", "tick_p", "tick_reason", "tick_row"])
            self.rows += processor.handleInputRows((0,), iter([rows]), Now(watermark))
        while expired := sorted(t for t in self.store.timers if t <= watermark * 1000):
            self.rows += processor.handleExpiredTimer((0,), Now(watermark), expired[0])
            self.store.timers.discard(expired[0])

    def found(self):
        out = pd.concat(self.rows, ignore_index=True).sort_values("tick_row", ignore_index=True)
        return out[out["tick_reason"].isna()].drop(columns="tick_reason")


def ticks_of(name, page, first, n, step, seed):
    rng = random.Random(seed)
    return [(name, page, first + k * step + rng.randrange(step), rng.uniform(1, 9)) for k in range(n)]


def split(ticks, n):
    ticks = sorted(ticks, key=lambda x: x[2])
    return [ticks[k * len(ticks) // n:(k + 1) * len(ticks) // n] for k in range(n)]


def test_the_series_of_a_slot_share_calls_and_requests():
    slot = Slot()
    ticks = [x for k in range(2000) for x in ticks_of(f"s{k}", k % ST.PAGES, 1_700_000_000, 12, 20_000, k)]
    for part in split(ticks, 3):
        slot.batch(part, max(x[2] for x in part))
    assert sorted(slot.found()["tick_row"]) == sorted(f"{s} {t} {p}" for s, _, t, p in ticks)
    assert sum(slot.store.calls.values()) < 2000               # a series of its own took some hundred each
    one = Slot()
    own = [x for x in ticks if x[0] == "s7"]
    one.batch(own, own[-1][2])
    got = slot.found()
    pd.testing.assert_frame_equal(got[got["tick_row"].str.startswith("s7 ")].reset_index(drop=True), one.found())


def test_only_pages_with_new_ticks_are_written():
    slot = Slot()
    slot.batch([x for k in range(ST.PAGES) for x in ticks_of(f"s{k}", k, 1_700_000_000, 3, 5000, k)])
    slot.store.written.clear()
    slot.batch([("s4", 4, 1_700_900_000, 2.0), ("new", 4, 1_700_900_000, 3.0)])
    assert slot.store.written == {(4, 0): 1, (): 1}


@pytest.mark.parametrize("seal, at_once", [(200, 0), (200, 1 << 26)])
def test_many_ticks_of_a_page_are_written_once_and_removed_in_time(monkeypatch, seal, at_once):
    ticks = (ticks_of("dense", 3, 1_700_000_000, 4000, 60, 1) + ticks_of("slow", 3, 1_700_000_000, 6, 40_000, 2)
             + ticks_of("other", 5, 1_700_000_000, 40, 6000, 3))
    whole = Slot()
    whole.batch(ticks, max(x[2] for x in ticks))
    monkeypatch.setattr(ST, "SEALED", seal)
    monkeypatch.setattr(ST, "AT_ONCE", at_once)
    slot = Slot()
    most = 0
    for part in split(ticks, 60):
        slot.batch(part, max(x[2] for x in part))
        most = max(most, len(slot.store.maps["ticks"]))
    pd.testing.assert_frame_equal(slot.found(), whole.found())
    sealed = [k for k in slot.store.written if k and k[1] > 0]
    assert len(sealed) > 10 and all(slot.store.written[k] == 1 for k in sealed)
    assert most <= 2 + 2 * 25 * 60 // seal + 2                 # 25 hours of ticks, some of them old
    assert len(whole.store.maps["ticks"]) == 2


def test_series_on_one_axis_equal_each_alone():
    parts, seconds = PLAN.parts, PLAN.seconds
    rng = np.random.default_rng(5)
    each = [tuple([np.sort(rng.integers(0, 200_000, n)), rng.normal(size=n), rng.random(n)]) for n in (1, 50, 400, 3)]
    alone = [ST.frame_values(lambda b: ST.NOTHING, {}, rows, 3600, parts, seconds)[0] for rows in each]
    axis = np.concatenate([rows[0] + k * 3600 * 100 for k, rows in enumerate(each)])
    rows = (axis, *[np.concatenate(c) for c in list(zip(*each))[1:]])
    assert np.array_equal(ST.frames(rows, np.arange(len(axis)), 3600, parts, seconds), np.concatenate(alone))


def test_slots_of_many_series_give_the_batch_metrics(spark, few_partitions, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ST, "GROUPS", 2)
    feed = Feed(spark)
    names = [None, "", *[f"s{k}" for k in range(200)]]
    rows = [r for k, name in enumerate(names) for r in hourly(name, 1_700_000_000 + 37 * k, 12, 9000)]
    rows += [(t, p + 1, s + 100, name) for t, p, s, name in rows[::9]]              # peers of the same second
    rows.sort(key=lambda r: r[0])
    late = [(rows[0][0], 5.0, 900, rows[0][3])]
    cut = next(k for k in range(len(rows) // 2, len(rows)) if rows[k - 1][0] < rows[k][0])       # no second is split
    feed.arrive(rows[:cut])
    feed.arrive(rows[cut:] + late)
    assert feed.metrics() == feed.want(rows)
    assert feed.quarantine() == {(rows[0][3], 900): ST.LATE}


def test_the_number_of_files_follows_the_rows_not_the_partitions(spark):
    own = spark.conf.get(ST.ADAPTIVE)
    feed = Feed(spark)
    days = [1_700_000_000 + d * 86400 for d in range(3)]
    feed.arrive([(t + 60 * k, 5.0, k, f"s{k}") for t in days for k in range(60)])
    files = feed.spark.read.parquet(os.path.join(feed.base, "metrics")).select("_metadata.file_path").distinct().count()
    dashboard = feed.spark.read.text(os.path.join(feed.base, "dashboard")).select("_metadata.file_path").distinct().count()
    assert files <= 3 * len(feed.sink.counts) and dashboard <= 3 * len(feed.sink.counts)
    assert spark.conf.get(ST.ADAPTIVE) == own


class NumberFeed(Feed):
    """Series are named by numbers."""

    def arrive(self, rows):
        rows = self.spark.createDataFrame(rows, "timestamp long, price double, seq long, symbol long")
        rows.coalesce(1).write.mode("append").json(os.path.join(self.root, "in"))
        stream = stream_json_ticks(self.spark, os.path.join(self.root, "in"), stream_tick_schema({"symbol": "long"}))
        q = ST.start_stateful(ST.stateful_metrics(stream, ("symbol",), extra=STANDIN_24H), self.sink, self.checkpoint,
                              available_now=True)
        q.awaitTermination()
        assert q.exception() is None


def test_a_missing_number_as_key_leaves_the_other_series_alone(spark, few_partitions):  # noqa: F811
    """A null once made all keys of its task fractions, and Spark then kept their state under one key."""
    feed = NumberFeed(spark)
    rows = [r for k in [None, *range(12)] for r in hourly(k, 1_700_000_000 + 100_000 * (k or 0), 6)]
    feed.arrive([r for r in rows if r[2] < 3])
    feed.arrive([r for r in rows if r[2] >= 3])
    assert {k for k in feed.metrics()} == {(r[3], r[2]) for r in rows}
    assert not os.path.exists(os.path.join(feed.base, "quarantine"))
