"""Parsing, quotes, candles, quality, sinks and sources."""

import json
import os

from pyspark.sql import functions as F

from volspark import sinks
from volspark.operators import clean as C
from volspark.schemas import CANDLE_COLUMNS, TICK_FIELDS
from volspark.session import scratch_path
from volspark.sources import files, kafka


def test_parse_ticks_bad_json(spark):
    lines = ['{"timestamp": 1, "price": 2.5, "datetime": "1970-01-01T00:00:01Z"}', "bad",
             '{"timestamp": 2, "price": "abc"}', '{"timestamp": 3, "price": null}',
             '{"timestamp": 4}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "seq long, value string")
    got = {r.seq: r for r in C.parse_ticks(df, keep=("seq",)).collect()}
    assert got[0].price == 2.5 and got[0].timestamp == 1
    assert all(got[1][c] is None for c in TICK_FIELDS)
    assert got[2].timestamp == 2 and got[2].price is None
    assert got[3].price is None and got[4].price is None
    q = C.quality_check(C.parse_ticks(df, keep=("seq",)))
    reasons = {r.seq: r.reject_reason for r in q.collect()}
    assert reasons == {0: None, 1: "null_timestamp", 2: "null_price", 3: "null_price",
                       4: "null_price"}


def test_json_source_keeps_rest_of_file(spark):
    d = scratch_path(spark, "json")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"timestamp": 1, "price": 1.0}\n\nnot json\n{"timestamp": 3, "price": 3.0}\n')
    df = files.read_json_ticks(spark, d)
    ts = sorted(r.timestamp for r in df.collect() if r.timestamp is not None)
    assert ts == [1, 3]
    bad = df.filter(F.col(files.CORRUPT).isNotNull()).select("timestamp", files.CORRUPT).collect()
    assert [(r.timestamp, r[files.CORRUPT]) for r in bad] == [(None, "not json")]


def test_flatten_quotes(spark):
    bodies = [
        json.dumps({"Response": "Error", "Message": "x"}),
        json.dumps({"RAW": {"BTC": {"USD": {"PRICE": 10.0, "MKTCAP": 5}, "EUR": {"PRICE": 9.0}}}}),
        json.dumps({"RAW": {"ETH": {"USD": {"PRICE": "oops"}}}}),
    ]
    df = spark.createDataFrame([(i, 100 + i, b) for i, b in enumerate(bodies)],
                               "seq long, timestamp long, body string")
    got = {(r.symbol, r.currency): r for r in C.flatten_quotes(df, keep=("seq",)).collect()}
    assert set(got) == {("BTC", "USD"), ("BTC", "EUR"), ("ETH", "USD")}
    assert got[("BTC", "USD")].market_cap == 5.0 and got[("BTC", "USD")].supply == 0.0
    assert got[("ETH", "USD")].price == 0.0
    assert got[("BTC", "EUR")].datetime == "1970-01-01T00:01:41Z"


def test_candles_parse_normalize_write(spark):
    ok = json.dumps({"Response": "Success", "Message": "", "Data": {"Data": [
        {"time": 3600, "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volumefrom": 3,
         "volumeto": 4.5}]}})
    err = json.dumps({"Response": "Error", "Message": "limit"})
    df = spark.createDataFrame([("BTC", "hourly", ok), ("BTC", "hourly", err)],
                               "symbol string, interval string, body string")
    n = C.normalize_candles(C.parse_candle_responses(df))
    assert n.columns == CANDLE_COLUMNS
    r = n.first()
    assert (r.timestamp, r.date, r.price, r.volume) == (3600, "1970-01-01", 1.5, 3.0)
    path = scratch_path(spark, "candles")
    sinks.write_candles(n, path)
    sinks.write_candles(n, path)        # rerun replaces, no duplicates
    assert spark.read.parquet(path).count() == 1
    assert os.path.isdir(os.path.join(path, "symbol=BTC", "interval=hourly"))


def test_history_write_is_idempotent_and_pruned(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x long, d string") \
        .withColumn("date", F.to_date("d")).drop("d")
    path = scratch_path(spark, "hist")
    sinks.write_history(df, path)
    sinks.write_history(df.filter("x = 2"), path)      # replay of one partition
    assert spark.read.parquet(path).count() == 2
    scan = files.read_history(spark, path, date_from="2024-01-02")
    assert scan.count() == 1
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_history_union(spark):
    s = spark.createDataFrame([(1, "t", 5, 1.0)], "timestamp long, datetime string, symbol long, price double") \
        .withColumn("date", F.to_date(F.lit("2024-01-01")))
    b = C.normalize_candles(spark.createDataFrame(
        [(3600, 1.0, 1.0, 1.0, 2.0, 1.0, 1.0)],
        "time long, open double, high double, low double, close double, volumefrom double, volumeto double"),
        symbol="BTC", interval="hourly")
    u = C.history_union(s, b.select("timestamp", "datetime", "date", "symbol", "interval", "price"))
    got = {r.source: r for r in u.collect()}
    assert got["stream"].symbol == "5" and got["stream"].interval is None
    assert got["bulk"].datetime == "1970-01-01T01:00:00Z"


def test_volume_audit(spark):
    path = scratch_path(spark, "vol")
    spark.range(1000).write.parquet(path)
    r = files.storage_volume(spark, path, 3.0).first()
    assert r.total_bytes > 0 and r.meets_minimum is False and r.shortfall_gb > 2.9


def test_kafka_options_and_value(spark):
    o = kafka.source_options("b:9092", "t")
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "true"
    s = kafka.sink_options("b:9092", "t")
    assert s["kafka.acks"] == "all" and s["kafka.compression.type"] == "gzip"
    v = kafka.to_kafka_value(spark.createDataFrame([(1, 2.0)], "timestamp long, price double"))
    assert v.first().value == '{"timestamp":1,"price":2.0}'


def test_quote_numbers_as_text_and_null(spark):
    body = json.dumps({"RAW": {"BTC": {"USD": {"PRICE": "123.5", "OPEN24HOUR": "n/a", "SUPPLY": None, "MKTCAP": 7}}}})
    df = spark.createDataFrame([(1, 5, body)], "seq long, timestamp long, body string")
    r = C.flatten_quotes(df).first()
    assert (r.price, r.open24h, r.supply, r.market_cap) == (123.5, 0.0, 0.0, 7.0)


def test_history_files_follow_the_dates(spark):
    df = spark.range(10_000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 30 as int)) as date").repartition(16)
    path = scratch_path(spark, "hfiles")
    sinks.write_history(df, path)
    n = spark.read.parquet(path).inputFiles()
    assert 30 <= len(n) <= 60


def test_latest_dates_only_are_read(spark):
    df = spark.range(300).selectExpr("id", "date_add(date'2024-01-01', cast(id div 10 as int)) as date")
    path = scratch_path(spark, "newest")
    sinks.write_history(df, path)
    found = files.read_latest(spark, path, 35)
    assert found.count() == 40 and "PartitionFilters: [isnotnull(date" in found._jdf.queryExecution().executedPlan().toString()
    assert files.read_latest(spark, path, 10_000).count() == 300


def test_malformed_datetime_is_not_available(spark):
    from volspark.functions.columns import display_time
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("soon",), (None,)], "t string")
    assert [r.x for r in df.select(display_time("t").alias("x")).collect()] == ["2024-01-02 03:04:05", "N/A", "N/A"]


def _zoned(spark, max_rows):
    df = spark.range(2000).selectExpr("id", "if(id % 100 = 7, null, id div 3) as timestamp",
                                      "date'2024-01-01' as date").repartition(7)
    path = scratch_path(spark, "zoned")
    sinks.write_zoned_history(df, path, max_rows=max_rows)
    return df, path


def test_zone_map_picks_files_of_one_date(spark):
    df, path = _zoned(spark, 100)
    every = spark.read.parquet(path).inputFiles()
    for n in (1, 95, 150):
        found = files.read_latest(spark, path, n)
        assert len(every) >= 20 and len(found.inputFiles()) <= n // 100 + 3
        assert set(found.inputFiles()) < set(every)
        at_least = df.orderBy(F.desc("timestamp")).limit(n).agg(F.min("timestamp")).first()[0]
        assert ({r.id for r in df.where(F.col("timestamp") >= at_least).collect()}
                == {r.id for r in found.where(F.col("timestamp") >= at_least).collect()})
    assert found.schema == spark.read.parquet(path).schema
    assert files.read_latest(spark, path, 1990).count() == 2000       # fewer rows with a time than that: all


def test_zone_map_follows_rewrites(spark):
    df, path = _zoned(spark, 100)
    more = df.selectExpr("id + 5000 as id", "timestamp + 900 as timestamp", "date'2024-01-02' as date")
    sinks.write_zoned_history(more, path, max_rows=100)
    assert {r.date.day for r in files.read_latest(spark, path, 10).collect()} == {2}
    assert {r.date.day for r in files.read_latest(spark, path, 2500).collect()} == {1, 2}
    sinks.write_history(more.withColumn("id", F.col("id") + 1), path)  # without zones: the whole date, counted
    assert files.read_latest(spark, path, 10).count() == 2000
    sinks.write_zoned_history(df.limit(0), path)
    assert files.read_latest(spark, path, 2500).count() == 4000
