"""Scale properties: a hot series spreads over buckets; keyed streams; file sources."""

import json
import os

from pyspark.sql import functions as F

from volspark.operators.clean import parse_candle_responses
from volspark.operators.metrics import tick_metrics, tick_metrics_window
from volspark.session import scratch_path
from volspark.sources import files
from volspark.streaming.stream import RollingMetricsSink


def test_hot_series_spreads_over_buckets(spark):
    # one symbol holds a third of all rows; its rows must not meet in one task
    n = 3000
    df = spark.range(n).select(
        (F.col("id") * 37).alias("timestamp"), F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50 + 2).alias("symbol"),
        (F.col("id") % 97 + 1).cast("double").alias("price"))
    m = tick_metrics(df, ("symbol",))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")     # tiny data: AQE would merge all partitions
    try:
        per_task = m.filter("symbol = 1").groupBy(F.spark_partition_id().alias("p")).count()
        counts = [r["count"] for r in per_task.collect()]
    finally:
        spark.conf.set(key, old)
    assert sum(counts) == n // 3 and max(counts) < n // 3     # spread over tasks
    a = {r.seq: r.volatility_24h for r in m.collect()}
    b = {r.seq: r.volatility_24h for r in tick_metrics_window(df, ("symbol",)).collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in b)


def test_keyed_stream_equals_batch(spark):
    base = scratch_path(spark, "ksink")
    sink = RollingMetricsSink(base, keys=("symbol",))
    data = [(i * 900, float(10 + i % 7), i, i % 3) for i in range(120)]
    df = spark.createDataFrame(data, "timestamp long, price double, seq long, symbol long")
    sink(df.filter("seq % 4 <> 0"), 0)
    sink(df.filter("seq % 4 = 0"), 1)            # late ticks of every symbol
    got = {r.seq: r.volatility_24h for r in spark.read.parquet(os.path.join(base, "metrics")).collect()}
    want = {r.seq: r.volatility_24h for r in tick_metrics(df, ("symbol",)).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_landed_candle_and_quote_files(spark):
    root = scratch_path(spark, "landed")
    d = os.path.join(root, "symbol=BTC", "interval=hourly")
    os.makedirs(d)
    with open(os.path.join(d, "page-0.json"), "w") as f:
        f.write(json.dumps({"Response": "Success", "Message": "", "Data": {"Data": [
            {"time": 0, "open": 1, "high": 1, "low": 1, "close": 1, "volumefrom": 1, "volumeto": 1},
            {"time": 3600, "open": 2, "high": 2, "low": 2, "close": 2, "volumefrom": 2, "volumeto": 4}]}}) + "\n")
        f.write(json.dumps({"Response": "Error", "Message": "limit"}) + "\n")
    raw = files.read_candle_responses(spark, root)
    got = parse_candle_responses(raw).orderBy("time").collect()
    assert [(r.symbol, r.interval, r.time, r.close) for r in got] == [
        ("BTC", "hourly", 0, 1.0), ("BTC", "hourly", 3600, 2.0)]
    qd = os.path.join(root, "quotes")
    os.makedirs(qd)
    with open(os.path.join(qd, "q.json"), "w") as f:
        f.write(json.dumps({"timestamp": 5, "seq": 1, "body": json.dumps(
            {"RAW": {"BTC": {"USD": {"PRICE": 3.0}}}})}) + "\n")
    from volspark.operators.clean import flatten_quotes
    q = flatten_quotes(files.read_quotes(spark, qd), keep=("seq",)).first()
    assert (q.symbol, q.currency, q.price, q.timestamp) == ("BTC", "USD", 3.0, 5)


def test_keyed_series_and_untimed_rows_equal_window_form(spark):
    from volspark.operators.metrics import STANDIN_24H
    data = [(i * 613 % 200000, float(1 + (i * 7) % 40), i, 0 if i % 2 else 1 + i % 9)
            for i in range(900)]
    data += [(None, 5.0, 10_000, 3)]
    df = spark.createDataFrame(data, "timestamp long, price double, seq long, symbol long")
    got = {r.seq: r for r in tick_metrics(df, ("symbol",), extra=STANDIN_24H).collect()}
    timed = df.filter("timestamp is not null")
    want = {r.seq: r for r in tick_metrics_window(timed, ("symbol",), extra=STANDIN_24H).collect()}
    assert set(got) == set(want) | {10_000}
    assert got[10_000].volatility_24h is None
    for k, w in want.items():
        for c in ("log_return", "volatility_1h", "volatility_24h", "price_ma_24h", "high24h"):
            a, b = got[k][c], w[c]
            assert (a is None and b is None) or abs(a - b) < 1e-9, (k, c, a, b)


def test_keyed_sumsq_frame(spark):
    data = [(i * 613 % 9000, float(1 + i % 7), i, i % 3) for i in range(200)]
    df = spark.createDataFrame(data, "timestamp long, price double, seq long, symbol long")
    extra = {"sq1h": ("sumsq", "price", 3600)}
    got = {r.seq: r.sq1h for r in tick_metrics(df, ("symbol",), extra=extra).collect()}
    want = {r.seq: r.sq1h for r in tick_metrics_window(df, ("symbol",), extra=extra).collect()}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want) and got.keys() == want.keys()


def test_narrow_common_bucket_is_rejected(spark):
    import pytest
    df = spark.createDataFrame([(0, 1.0, 1)], "timestamp long, price double, seq long")
    with pytest.raises(ValueError, match="bucket"):
        tick_metrics(df, extra={"m": ("max", "price", 3601)})


def test_keyed_plan_reads_twice_and_joins_by_bucket(spark):
    """At most two scans, and no join or window over rows on the bare series key."""
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "unix_timestamp(ts) as timestamp", "event_id as seq", "user_id as symbol", "value as price")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tick_metrics(df, ("symbol",))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("FileScan parquet") <= 2
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]
    assert joins and all("_b#" in line for line in joins), joins


def test_rows_that_compress_well_keep_their_tasks(spark):
    """Adaptive execution merges tasks by compressed bytes: equal prices would meet in one."""
    df = spark.range(4000).selectExpr("id * 300 as timestamp", "id as seq", "1.0D as price")
    from volspark.operators.rolling import TASKS_PER_CORE
    m = tick_metrics(df)
    used = m.select(F.spark_partition_id().alias("p"), "seq").groupBy("p").count().collect()
    hours = 4000 * 300 // 3600
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, 8)
    assert len(used) > min(hours, tasks) // 2 and max(r["count"] for r in used) < 4000 // 8
    assert len(tick_metrics(df, spread=False).select(F.spark_partition_id()).distinct().collect()) < len(used)


def test_frames_get_one_copy_a_second_and_one_sort(spark, monkeypatch):
    """Rows of one second share a copy per frame, and only the copies' exchange is sorted again."""
    from volspark.operators import rolling
    from volspark.operators.metrics import STANDIN_24H
    n, seconds = 3000, 60
    df = spark.range(n).selectExpr(f"id % {seconds} * 1700 as timestamp", "id as seq", "double(id % 13 + 1) as price")
    dealt, real = [], rolling._dealt
    monkeypatch.setattr(rolling, "_dealt", lambda d, *a: (dealt.append(d), real(d, *a))[1])
    m = tick_metrics(df, extra=STANDIN_24H)
    hours = seconds * 1700 // 3600 + 1
    assert dealt[-1].count() <= n + 2 * seconds + 23 * hours       # was three rows a tick
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert sum("Sort [" in line and "_okey" in line for line in plan.splitlines()) == 1     # was two
    got = {r.seq: r for r in m.collect()}
    want = {r.seq: r for r in tick_metrics_window(df, extra=STANDIN_24H).collect()}
    for k, w in want.items():
        for c in ("log_return", "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h",
                  "volume24h", "high24h", "low24h"):
            a, b = got[k][c], w[c]
            assert (a is None and b is None) or abs(a - b) < 1e-9 * max(1, abs(b)), (k, c, a, b)


def test_carry_table_is_aggregated_by_hash(spark):
    """The last price of each bucket: a scan task holds its buckets, not its rows."""
    df = spark.range(600).selectExpr("id * 700 as timestamp", "id as seq", "id % 9 as symbol", "double(id % 13 + 1) as price")
    for keys in ((), ("symbol",)):
        plan = tick_metrics(df, keys)._jdf.queryExecution().executedPlan().toString()
        assert "max_by" in plan and "SortAggregate" not in plan


def test_order_number_orders_as_the_pair(spark):
    """Null first, then by time, then by seq, over the whole range of a seq."""
    from volspark.operators.rolling import order_number
    ends = [None, -(1 << 63), -1, 0, 1, (1 << 63) - 1]
    times = [None, -(1 << 61), -3601, -1, 0, 1, 1_700_000_000, 1 << 61]
    data = [(t, s) for t in times for s in ends]
    df = spark.createDataFrame(data[::-1], "t long, s long")
    found = df.select("t", "s", order_number(df, "t", "s").alias("n")).orderBy("n").collect()
    assert [(r.t, r.s) for r in found] == data and len({r.n for r in found}) == len(data)
    text = spark.createDataFrame([(1, "b"), (1, "a")], "t long, s string")
    assert text.orderBy(order_number(text, "t", "s")).first().s == "a"      # other types stay a pair


def test_rows_of_files_are_dealt_twice_beyond_the_bypass_threshold(spark):
    """More parts than Spark writes without gathering a scan task's rows: a first exchange of that many."""
    from volspark.operators.rolling import TASKS_PER_CORE
    df = spark.range(900).selectExpr("id * 700 as timestamp", "id as seq", "id % 9 as symbol", "double(id % 13 + 1) as price")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    most = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    try:
        for parts in (most + 50, most):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            for keys in ((), ("symbol",)):
                m = tick_metrics(df, keys)
                tasks = max(parts, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
                dealt = int(tasks > most)
                plan = m._jdf.queryExecution().executedPlan().toString()
                first = [x for x in plan.splitlines() if f", {most})" in x and "_first_b" in x]
                assert len(first) == dealt and f", {tasks})" in plan, plan
                if parts == most or not keys:
                    continue
                got = {r.seq: r.volatility_24h for r in m.collect()}
                want = {r.seq: r.volatility_24h for r in tick_metrics_window(df, keys).collect()}
                assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
