"""Candle tables of many series: folders by bucket, landed files of many series, unchanged results."""

import json
import os

from volspark import sinks
from volspark.plans.jobs import candle_backfill
from volspark.session import scratch_path
from volspark.sources import files

HOUR = 3600
COLUMNS = ("symbol", "timestamp", "price", "log_return", "volatility_24h", "price_ma_1h")


def land(spark, found, extra=()):
    """A landed file of many series: {symbol: [(hour, price), ...]}, and ``extra`` lines."""
    root = scratch_path(spark, "landed")
    os.makedirs(root)
    with open(os.path.join(root, "part-0.json"), "w") as f:
        for symbol, candles in found.items():
            data = [{"time": k * HOUR, "open": 1.0, "high": 2.0, "low": 0.5, "close": p, "volumefrom": 1.0, "volumeto": 1.0}
                    for k, p in candles]
            body = json.dumps({"Response": "Success", "Data": {"Data": data}})
            f.write(json.dumps({"symbol": symbol, "interval": "hourly", "body": body}) + "\n")
        f.writelines(line + "\n" for line in extra)
    return root


def folders(path):
    return sorted(n for n in os.listdir(path) if "=" in n)


def stored(spark, path):
    rows = spark.read.parquet(path).select(*COLUMNS).collect()
    return sorted((str(r[0]), *r[1:3], *[round(x, 9) for x in r[3:]]) for r in rows)


def test_buckets_hold_what_folders_hold(spark, monkeypatch):
    """Three landings, the second with some of the series, the third with older candles."""
    series = [f"S{k}" for k in range(12)] + ["7"]
    landings = [land(spark, {s: [(k, 5.0 + (k * n) % 7) for k in range(20)] for n, s in enumerate(series)}, ["{broken"]),
                land(spark, {s: [(19, 50.0), (20, 51.0)] for s in series[:3]}),
                land(spark, {"7": [(-9, 3.0)]})]
    found = {}
    for limit in (1000, 5):
        monkeypatch.setattr(sinks, "MAX_SERIES_FOLDERS", limit)
        monkeypatch.setattr(sinks, "SERIES_BUCKETS", 4)          # so that series share buckets
        base = scratch_path(spark, "backfill")
        for landing in landings:
            out = candle_backfill(spark, landing, base)
        found[limit] = stored(spark, out["metrics"])
        assert len(found[limit]) == 13 * 20 + 3 + 1
        assert spark.read.parquet(out["candles"]).count() == len(found[limit])
    assert found[1000] == found[5]
    assert len(folders(out["candles"])) <= 4 and len(folders(out["metrics"])) <= 4


def test_overwriting_a_bucket_keeps_its_other_series(spark, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_SERIES_FOLDERS", 1)
    monkeypatch.setattr(sinks, "SERIES_BUCKETS", 1)
    path = scratch_path(spark, "candles")
    schema = "symbol string, interval string, timestamp long, price double"
    sinks.write_candles(spark.createDataFrame(
        [("A", "h", 1, 1.0), ("A", "h", 2, 1.0), ("B", "h", 1, 2.0), (None, "h", 1, 3.0)], schema), path)
    assert folders(path) == ["series_bucket=0"]
    for _ in range(2):
        sinks.write_candles(spark.createDataFrame([("A", "h", 5, 9.0), (None, "h", 7, 4.0)], schema), path)
        got = spark.read.parquet(path).select("symbol", "timestamp", "price").collect()
        assert sorted(map(tuple, got), key=str) == [("A", 5, 9.0), ("B", 1, 2.0), (None, 7, 4.0)]


def test_landed_lines(spark):
    raw = files.read_candle_responses(spark, land(spark, {"A": [(1, 2.0)]}, ["{broken"])).collect()
    assert {(r.symbol, r.interval, r.body[:9]) for r in raw} == {("A", "hourly", '{"Respons'), (None, None, "{broken")}
