"""Candle backfill in several landings, candle gaps, and reads beside rows without a date."""

import json
import os

import pytest

from volspark import sinks
from volspark.operators.clean import candle_gaps, history_merge, latest_candles, normalize_candles
from volspark.operators.metrics import candle_metrics, tick_metrics
from volspark.operators.clean import enrich_ticks
from volspark.plans.jobs import candle_backfill
from volspark.session import scratch_path
from volspark.sources.files import read_latest, stored_dates

HOUR = 3600


def candle(k, price=None):
    price = 10.0 + k * 3 % 7 if price is None else price
    return {"time": k * HOUR, "open": 1.0, "high": 20.0, "low": 0.5, "close": price, "volumefrom": 2.0, "volumeto": 3.0}


def land(spark, pages, name="1"):
    """Landed responses: {symbol: [page, ...]}, a page is a list of candles or a text."""
    root = scratch_path(spark, "landed")
    for symbol, found in pages.items():
        folder = os.path.join(root, f"symbol={symbol}", "interval=hourly")
        os.makedirs(folder)
        for n, page in enumerate(found):
            body = page if isinstance(page, str) else json.dumps({"Response": "Success", "Data": {"Data": page}})
            with open(os.path.join(folder, f"{n}.json"), "w") as f:
                f.write(body + "\n")
            os.utime(os.path.join(folder, f"{n}.json"), (1_000_000 + n, 1_000_000 + n))
    return root


def stored(spark, path, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*columns).collect())


def metrics_of(spark, rows):
    raw = spark.createDataFrame([(s, "hourly", c["time"], *[float(c[k]) for k in (
        "open", "high", "low", "close", "volumefrom", "volumeto")]) for s, c in rows],
        "symbol string, interval string, time long, open double, high double, low double, close double, "
        "volumefrom double, volumeto double")
    m = candle_metrics(normalize_candles(raw)).select("symbol", "timestamp", "price", "log_return", "volatility_24h", "price_ma_1h")
    return sorted((*r[:3], *[round(x, 9) for x in r[3:]]) for r in m.collect())


def written(path):
    return {d: sorted(os.stat(os.path.join(d, f)).st_mtime_ns for f in files)
            for d, _, files in os.walk(path) if "interval=" in d}


def test_landings_add_up(spark):
    out_dir = scratch_path(spark, "backfill")
    columns = ("symbol", "timestamp", "price", "log_return", "volatility_24h", "price_ma_1h")

    def check(rows):
        got = sorted((str(r[0]), *r[1:3], *[round(x, 9) for x in r[3:]]) for r in stored(spark, out["metrics"], *columns))
        assert got == metrics_of(spark, rows)
        assert len(stored(spark, out["candles"], "symbol", "timestamp")) == len(rows)

    # pages overlap within the landing: the newer file wins; symbols that look like numbers stay text
    out = candle_backfill(spark, land(spark, {
        "7": [[candle(k) for k in range(40)], [candle(39, 15.0)]],
        "B": [[candle(k) for k in range(5)], '{"Response":"Error"}']}), out_dir)
    seven = [candle(k) for k in range(39)] + [candle(39, 15.0)]
    b = [("B", candle(k)) for k in range(5)]
    check([("7", c) for c in seven] + b)

    # an overlapping landing replaces what it polled again and adds the rest
    before = written(out["metrics"])
    landing = land(spark, {"7": [[candle(38, 99.0), candle(39)], [candle(k) for k in range(40, 60)]]})
    candle_backfill(spark, landing, out_dir)
    check([("7", c) for c in [candle(k) for k in range(38)] + [candle(38, 99.0), candle(39)]
           + [candle(k) for k in range(40, 60)]] + b)
    after = written(out["metrics"])
    assert {d for d in after if after[d] != before.get(d)} == {d for d in after if "symbol=7" in d}

    # the same landing again changes nothing
    before = written(out["metrics"])
    candle_backfill(spark, landing, out_dir)
    assert written(out["metrics"]) == before

    # older candles: everything after them is computed anew
    candle_backfill(spark, land(spark, {"B": [[candle(k) for k in (-30, -3)]]}), out_dir)
    got = [r for r in stored(spark, out["metrics"], *columns) if r[0] == "B"]
    assert len(got) == 7 and got[2][3] != 0.0


def test_a_run_cut_off_before_the_metrics_is_made_good(spark):
    out_dir = scratch_path(spark, "backfill")
    out = candle_backfill(spark, land(spark, {"A": [[candle(k) for k in range(10)]]}), out_dir)
    full = [candle(k) for k in range(10)] + [candle(10, 50.0)]
    raw = spark.createDataFrame([("A", "hourly", c["time"], *[float(c[k]) for k in (
        "open", "high", "low", "close", "volumefrom", "volumeto")]) for c in full],
        "symbol string, interval string, time long, open double, high double, low double, close double, "
        "volumefrom double, volumeto double")
    sinks.write_candles(normalize_candles(raw), out["candles"])         # candles stored, then the run ended
    candle_backfill(spark, land(spark, {"A": [[candle(10, 50.0)]]}), out_dir)
    assert len(stored(spark, out["metrics"], "timestamp")) == 11


def test_latest_candles(spark):
    rows = [("A", "h", 1, 5.0, 1), ("A", "h", 1, 4.0, 2), ("A", "h", 1, 4.5, 2), ("A", "h", 2, 1.0, 1), ("B", "h", 1, None, 3)]
    got = latest_candles(spark.createDataFrame(rows, "symbol string, interval string, timestamp long, price double, v long"), "v")
    assert got.columns == ["symbol", "interval", "timestamp", "price"]
    assert sorted(map(tuple, got.collect())) == [("A", "h", 1, 4.5), ("A", "h", 2, 1.0), ("B", "h", 1, None)]


def test_gaps_and_repeats(spark):
    minute = [("A", "minute", 60 * k) for k in (0, 1, 2, 2, 2, 3, 3, 5, 9, 9)]
    hourly = [("A", "hourly", HOUR * k) for k in (4, 5)] + [("B", "hourly", 0)]
    other = [("A", "weekly", 0), ("A", "weekly", 9), ("A", "minute", None)]
    rows = spark.createDataFrame(minute + hourly + other, "symbol string, interval string, timestamp long")
    got = sorted(map(tuple, candle_gaps(rows, {"minute": 60, "hourly": HOUR}).collect()))
    assert got == [("A", "minute", "missing", 240, 240, 1), ("A", "minute", "missing", 360, 480, 3),
                   ("A", "minute", "repeated", 120, 180, 3), ("A", "minute", "repeated", 540, 540, 1)]
    assert candle_gaps(rows.where("false"), {"minute": 60}).collect() == []


def test_candles_fill_only_what_ticks_leave_open(spark):
    ticks = spark.createDataFrame([("A", HOUR + 5, 1.0), ("B", 0, 2.0)], "symbol string, timestamp long, price double")
    rows = [("A", "hourly", k * HOUR, 9.0) for k in (0, 1, 2)] + [("B", "hourly", 0, 9.0)]
    rows += [("A", "minute", 2 * HOUR + 60 * k, 8.0) for k in (0, 3)] + [("A", "minute", HOUR, 8.0), ("A", "minute", HOUR + 60, 8.0)]
    bulk = spark.createDataFrame(rows, "symbol string, interval string, timestamp long, price double").selectExpr(
        "*", "timestamp_seconds(timestamp) as datetime", "'1970-01-01' as date")
    got = history_merge(ticks, bulk, {"hourly": HOUR, "minute": 60})
    assert sorted((r.source, r.symbol, r.timestamp, r.price) for r in got.collect()) == [
        ("bulk", "A", 0, 9.0), ("bulk", "A", HOUR + 60, 8.0), ("bulk", "A", 2 * HOUR, 8.0), ("bulk", "A", 2 * HOUR + 180, 8.0),
        ("stream", "A", HOUR + 5, 1.0), ("stream", "B", 0, 2.0)]
    with pytest.raises(Exception, match="no step for interval minute"):
        history_merge(ticks, bulk, {"hourly": HOUR}).collect()


def test_rows_without_a_date_do_not_stop_the_dashboard(spark):
    path = scratch_path(spark, "history")
    rows = [(None, 1.0, 0)] + [(86400 * d + 5, 2.0 + d, d) for d in range(1, 4)]
    m = tick_metrics(enrich_ticks(spark.createDataFrame(rows, "timestamp long, price double, seq long")))
    sinks.write_history(m, path)
    assert [d.day for d in stored_dates(spark, path)] == [4, 3, 2]
    assert {r.seq for r in read_latest(spark, path, 2).collect()} == {2, 3}
