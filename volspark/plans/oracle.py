"""DuckDB oracle SQL for the registered queries (tables are pre-registered views).

Comparison rounding, applied identically on the Spark side:
``R6(x) = round(x + 1e-9, 6) + 0.0`` for metrics, ``R2(x) = round(x, 2) + 0.0``
for sums; counts and hours are BIGINT.
"""

from __future__ import annotations


def R6(x: str) -> str:
    return f"(round(({x}) + 1e-9, 6) + 0.0)"


def R2(x: str) -> str:
    return f"(round({x}, 2) + 0.0)"


TICKS = """ticks AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", event_id AS seq, user_id AS symbol,
         value AS price, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS datetime,
         date_trunc('second', ts) AS event_time,
         CAST(ts AS DATE) AS date, CAST(hour(ts) AS BIGINT) AS hour_of_day
  FROM events)"""


def metrics_cte(keyed: bool = False, src: str = "ticks", part: str | None = None,
                seq: str = "seq") -> str:
    """ticks -> r (returns) -> m (all metrics + 24h stand-ins)."""
    if part is None:
        part = "PARTITION BY symbol " if keyed else ""
    return f"""p AS (
  SELECT *, lag(price) OVER ({part}ORDER BY "timestamp", {seq}) AS prev_price FROM {src}),
r AS (
  SELECT * EXCLUDE (prev_price),
    CASE WHEN prev_price IS NOT NULL AND prev_price > 0
         THEN CASE WHEN price > 0 THEN ln(price / prev_price) END ELSE 0.0 END AS log_return,
    CASE WHEN prev_price IS NOT NULL AND prev_price > 0
         THEN (price - prev_price) / prev_price * 100 ELSE 0.0 END AS price_change_pct
  FROM p),
m AS (
  SELECT *,
    coalesce(stddev_samp(log_return) OVER w1, 0.0) AS volatility_1h,
    coalesce(stddev_samp(log_return) OVER w24, 0.0) AS volatility_24h,
    coalesce(avg(price) OVER w1, price) AS price_ma_1h,
    coalesce(avg(price) OVER w24, price) AS price_ma_24h,
    sum(price) OVER w24 AS volume24h, max(price) OVER w24 AS high24h, min(price) OVER w24 AS low24h
  FROM r
  WINDOW w1 AS ({part}ORDER BY "timestamp" RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
         w24 AS ({part}ORDER BY "timestamp" RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW))"""


def with_metrics(body: str, keyed: bool = False) -> str:
    return f"WITH {TICKS},\n{metrics_cte(keyed)}\n{body}"


METRIC_SELECT = f"""SELECT seq, "timestamp", price, {R6('log_return')} AS log_return,
  {R6('price_change_pct')} AS price_change_pct,
  {R6('volatility_1h')} AS volatility_1h, {R6('volatility_24h')} AS volatility_24h,
  {R6('price_ma_1h')} AS price_ma_1h, {R6('price_ma_24h')} AS price_ma_24h,
  {R2('volume24h')} AS volume24h, high24h, low24h"""

DAILY = f"""SELECT date, {R6('avg(price)')} AS avg_price, max(price) AS max_price, min(price) AS min_price,
  {R6('avg(volatility_24h)')} AS avg_vol, {R6('max(volatility_24h)')} AS max_vol,
  {R6('min(volatility_24h)')} AS min_vol, {R6('stddev_samp(volatility_24h)')} AS std_vol,
  {R2('sum(volume24h)')} AS total_volume, count(*) AS record_count FROM m GROUP BY date"""

HOURLY = f"""SELECT hour_of_day, {R6('avg(volatility_1h)')} AS avg_vol_1h,
  {R6('avg(volatility_24h)')} AS avg_vol_24h, count(*) AS record_count FROM m GROUP BY hour_of_day"""

THRESHOLD = "(SELECT quantile_disc(volatility_24h, 0.99) FROM m)"

SPIKES = f"""SELECT datetime, date, price, {R6('volatility_24h')} AS volatility_24h,
  {R2('volume24h')} AS volume24h, high24h, low24h
FROM m WHERE volatility_24h > {THRESHOLD}"""

LATEST = """latest AS (SELECT * FROM m ORDER BY "timestamp" DESC, seq DESC LIMIT 1000)"""


def with_latest(body: str) -> str:
    return f"WITH {TICKS},\n{metrics_cte()},\n{LATEST}\n{body}"


CANDLES = f"""candles AS (
  SELECT 'S' || CAST(symbol AS VARCHAR) AS symbol, 'hourly' AS interval,
    "timestamp" - ("timestamp" % 3600) AS time,
    arg_min(price, row("timestamp", seq)) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, row("timestamp", seq)) AS close,
    CAST(count(*) AS DOUBLE) AS volumefrom, sum(price) AS volumeto
  FROM ticks GROUP BY ALL),
cn AS (
  SELECT time AS "timestamp", make_timestamp(time * 1000000) AS datetime,
    strftime(make_timestamp(time * 1000000), '%Y-%m-%d') AS date, symbol, interval,
    close AS price, open, high, low, volumefrom AS volume, volumeto
  FROM candles)"""

def _quote(i: int, name: str) -> str:
    zero = {"open24h": " OR event_id % 11 = 4", "high24h": " OR event_id % 11 = 5"}.get(name, "")
    return f"CASE WHEN event_id % 7 = 0{zero} THEN 0.0 ELSE value + {i} END AS {name}"


QUOTES = f"""q AS (
  SELECT event_id AS seq, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
    strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS datetime,
    'S' || CAST(user_id AS VARCHAR) AS symbol, 'USD' AS currency, value AS price,
    {", ".join(_quote(i + 1, n) for i, n in enumerate(
        ["open24h", "high24h", "low24h", "volume24h", "volumeto24h", "change24h", "changepct24h",
         "market_cap", "supply"]))}
  FROM events WHERE event_id % 50 <> 0 AND event_id % 53 <> 1 AND event_id % 59 <> 2)"""

TICK_REST = ["open24h", "high24h", "low24h", "volume24h", "volumeto24h", "change24h", "changepct24h",
             "market_cap", "supply"]
TICK_WIDE = ", ".join(f"price + {i + 1} AS {n}" for i, n in enumerate(TICK_REST))

HISTORY_SELECT = METRIC_SELECT + ", date"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["tick_metrics"] = with_metrics(METRIC_SELECT + " FROM m")
    q["tick_metrics_by_symbol"] = with_metrics(
        METRIC_SELECT.replace("SELECT seq,", "SELECT seq, symbol,") + " FROM m", keyed=True)
    q["tick_metrics_bucketed"] = q["tick_metrics"]
    q["tick_metrics_blocks"] = q["tick_metrics"]
    q["log_return"] = with_metrics(f"SELECT seq, {R6('log_return')} AS log_return FROM m")
    q["price_change_pct"] = with_metrics(
        f"SELECT seq, {R6('price_change_pct')} AS price_change_pct FROM m")
    q["volatility_1h"] = with_metrics(f"SELECT seq, {R6('volatility_1h')} AS volatility_1h FROM m")
    q["volatility_24h"] = with_metrics(f"SELECT seq, {R6('volatility_24h')} AS volatility_24h FROM m")
    q["price_ma_1h"] = with_metrics(f"SELECT seq, {R6('price_ma_1h')} AS price_ma_1h FROM m")
    q["price_ma_24h"] = with_metrics(f"SELECT seq, {R6('price_ma_24h')} AS price_ma_24h FROM m")
    q["daily_stats"] = with_metrics(DAILY)
    q["daily_stats_head"] = with_metrics(f"SELECT * FROM ({DAILY}) ORDER BY date LIMIT 10")
    q["hourly_pattern"] = with_metrics(HOURLY)
    q["peak_hour"] = with_metrics(
        f"SELECT hour_of_day, avg_vol_1h FROM (SELECT hour_of_day, avg(volatility_1h) AS a, "
        f"{R6('avg(volatility_1h)')} AS avg_vol_1h FROM m GROUP BY hour_of_day) "
        f"ORDER BY a DESC, hour_of_day LIMIT 1")
    q["spike_threshold"] = with_metrics(
        f"SELECT {R6('quantile_disc(volatility_24h, 0.99)')} AS threshold FROM m")
    q["volatility_spikes"] = with_metrics(SPIKES)
    q["top_spikes"] = with_metrics(
        f"SELECT * FROM ({SPIKES}) ORDER BY volatility_24h DESC, datetime DESC LIMIT 20")
    q["analysis_summary"] = with_metrics(
        f"SELECT count(*) AS total_records, count(DISTINCT date) AS total_days, "
        f"count(*) FILTER (WHERE volatility_24h > {THRESHOLD}) AS spike_count FROM m")
    q["event_time_enrich"] = f"""WITH {TICKS}
SELECT seq, "timestamp", event_time, date FROM ticks"""
    q["sql_avg_price_by_date"] = f"""WITH {TICKS}
SELECT date, {R6('avg(price)')} AS avg_price, count(*) AS n FROM ticks GROUP BY date"""
    q["dashboard_projection"] = with_metrics(
        f"""SELECT "timestamp", datetime, event_time, price, {R6('log_return')} AS log_return,
  {R6('volatility_1h')} AS volatility_1h, {R6('volatility_24h')} AS volatility_24h,
  {R6('price_ma_1h')} AS price_ma_1h, {R6('price_ma_24h')} AS price_ma_24h,
  {R6('price_change_pct')} AS price_change_pct, {R2('volume24h')} AS volume24h,
  high24h, low24h FROM m""")
    q["latest_n"] = f"""WITH {TICKS}
SELECT seq, "timestamp", price FROM ticks ORDER BY "timestamp" DESC, seq DESC LIMIT 1000"""
    q["latest_n_zoned"] = q["latest_n"]
    q["latest_kpis"] = with_metrics(f"""SELECT
  '$' || format('{{:,.2f}}', price) AS current_price,
  coalesce(printf('%.6f', volatility_24h), 'N/A') AS current_volatility,
  coalesce('$' || format('{{:,.0f}}', volume24h), 'N/A') AS current_volume,
  strftime(CAST(replace(datetime, 'Z', '') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS last_update
FROM m ORDER BY "timestamp" DESC, seq DESC LIMIT 1""")
    q["chart_price"] = with_latest(f"""SELECT event_time, price, {R6('price_ma_1h')} AS price_ma_1h, {R6('price_ma_24h')} AS price_ma_24h,
  {R6('volatility_24h')} AS volatility_24h FROM latest""")
    q["chart_volatility"] = with_latest(f"""SELECT event_time, {R6('volatility_1h')} AS volatility_1h, {R6('volatility_24h')} AS volatility_24h
FROM latest""")
    q["chart_volume"] = with_latest(f"""SELECT event_time, {R2('volume24h')} AS volume24h FROM latest""")
    q["series_availability"] = with_latest(f"""SELECT bool_or(price_ma_1h IS NOT NULL) AS has_price_ma_1h,
  bool_or(price_ma_24h IS NOT NULL) AS has_price_ma_24h,
  bool_or(volatility_1h IS NOT NULL) AS has_volatility_1h,
  bool_or(volatility_24h IS NOT NULL) AS has_volatility_24h,
  bool_or(volume24h IS NOT NULL) AS has_volume24h FROM latest""")
    for name, sec in (("candle_minute", 60), ("candle_hour", 3600)):
        q[name] = f"""WITH {TICKS}
SELECT symbol, "timestamp" - ("timestamp" % {sec}) AS time,
  arg_min(price, row("timestamp", seq)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, row("timestamp", seq)) AS close,
  CAST(count(*) AS DOUBLE) AS volumefrom, {R2('sum(price)')} AS volumeto
FROM ticks GROUP BY ALL"""
    # --- ingest side
    q["tick_parse"] = f"""WITH {TICKS}
SELECT seq, "timestamp", datetime, price, {TICK_WIDE} FROM ticks"""
    wide = ", ".join(f"'{n}': price + {i + 1}" for i, n in enumerate(TICK_REST))
    q["tick_serialize"] = f"""WITH {TICKS}
SELECT seq, CAST(to_json({{'timestamp': "timestamp", 'datetime': datetime, 'price': price, {wide}}}) AS VARCHAR) AS value
FROM ticks"""
    q["json_ticks_roundtrip"] = q["dashboard_projection"]
    q["quote_flatten"] = f"""WITH {QUOTES}
SELECT seq, "timestamp", datetime, symbol, currency, price FROM q"""
    q["quote_defaults"] = f"""WITH {QUOTES}
SELECT seq, open24h, high24h, low24h, volume24h, volumeto24h, change24h, changepct24h,
  market_cap, supply FROM q"""
    q["feed_health"] = """SELECT count(*) FILTER (WHERE ok) AS messages, count(*) FILTER (WHERE NOT ok) AS errors,
  count(*) FILTER (WHERE ok) * 100.0 / count(*) AS success_rate_pct
FROM (SELECT event_id % 50 <> 0 AND event_id % 53 <> 1 AND event_id % 59 <> 2 AS ok FROM events)"""
    q["candle_parse"] = f"""WITH {TICKS},
{CANDLES}
SELECT symbol, interval, time, open, high, low, close, volumefrom, {R2('volumeto')} AS volumeto
FROM candles"""
    q["candle_normalize"] = f"""WITH {TICKS},
{CANDLES}
SELECT "timestamp", datetime, date, symbol, interval, price, open, high, low, volume,
  {R2('volumeto')} AS volumeto FROM cn"""
    q["candle_metrics"] = f"""WITH {TICKS},
{CANDLES},
{metrics_cte(src="cn", part='PARTITION BY symbol, interval ', seq='"timestamp"')}
SELECT symbol, interval, "timestamp", price, {R6('log_return')} AS log_return,
  {R6('price_change_pct')} AS price_change_pct,
  {R6('volatility_1h')} AS volatility_1h, {R6('volatility_24h')} AS volatility_24h,
  {R6('price_ma_1h')} AS price_ma_1h, {R6('price_ma_24h')} AS price_ma_24h FROM m"""
    q["quality_check"] = f"""WITH {TICKS},
qi AS (SELECT seq, CASE seq % 11 WHEN 3 THEN "timestamp" * 1000 WHEN 6 THEN NULL ELSE "timestamp" END AS t,
    CASE seq % 11 WHEN 0 THEN 0.0 WHEN 1 THEN -price WHEN 2 THEN NULL WHEN 4 THEN CAST('NaN' AS DOUBLE)
      WHEN 5 THEN CAST('Infinity' AS DOUBLE) ELSE price END AS price,
    CASE seq % 11 WHEN 7 THEN -1.0 WHEN 8 THEN CAST('NaN' AS DOUBLE) ELSE price END AS volume FROM ticks),
qr AS (SELECT seq, price, CASE WHEN t IS NULL THEN 'null_timestamp'
    WHEN t < 0 OR t > 4102444799 THEN 'timestamp_out_of_range'
    WHEN price IS NULL THEN 'null_price' WHEN NOT isfinite(price) THEN 'non_finite_price'
    WHEN price <= 0 THEN 'non_positive_price' WHEN NOT isfinite(volume) THEN 'non_finite_volume'
    WHEN volume < 0 THEN 'negative_volume' END AS reject_reason FROM qi)
SELECT seq, CASE WHEN reject_reason IS NULL THEN price END AS price, reject_reason FROM qr"""
    q["schema_guard"] = with_metrics(f"""SELECT date, event_time, datetime, price,
  {R6('volatility_1h')} AS volatility_1h, {R6('volatility_24h')} AS volatility_24h,
  {R2('volume24h')} AS volume24h, high24h, low24h FROM m""")
    q["history_union"] = f"""WITH {TICKS},
{CANDLES}
SELECT 'stream' AS source, "timestamp", datetime, date, CAST(symbol AS VARCHAR) AS symbol,
  NULL::VARCHAR AS interval, price FROM ticks
UNION ALL
SELECT 'bulk', "timestamp", strftime(datetime, '%Y-%m-%dT%H:%M:%SZ'), CAST(date AS DATE), symbol,
  interval, price FROM cn"""
    # --- sinks, read back
    q["history_write_read"] = with_metrics(HISTORY_SELECT + " FROM m")
    q["history_scan_pruned"] = with_metrics(
        HISTORY_SELECT + " FROM m WHERE date >= DATE '2024-01-24'")
    q["analysis_roundtrip"] = q["daily_stats"]
    q["candle_write_read"] = q["candle_normalize"]
    # --- streaming: the stream result equals the batch metrics
    for k in ("stream_tick_metrics", "stream_restart", "stream_late_ticks", "stream_replay"):
        q[k] = q["tick_metrics"]
    q["stream_fanout"] = q["dashboard_projection"]
    q["stream_stateful_metrics"] = q["tick_metrics_by_symbol"]
    # every 13th tick arrives last: too late unless it is newer than all others of its series
    fresh = (""" e AS (SELECT symbol, max("timestamp") AS newest FROM ticks WHERE seq % 13 <> 0 GROUP BY symbol),
a AS (SELECT ticks.*, seq % 13 = 0 AND "timestamp" <= newest AS late FROM ticks LEFT JOIN e USING (symbol)),
t AS (SELECT * FROM a WHERE late IS NOT TRUE)""")
    keyed = METRIC_SELECT.replace("SELECT seq,", "SELECT seq, symbol,")
    none = ", ".join(f"NULL AS {c}" for c in (
        "log_return", "price_change_pct", "volatility_1h", "volatility_24h", "price_ma_1h", "price_ma_24h",
        "volume24h", "high24h", "low24h"))
    q["stream_stateful_late"] = (
        f"WITH {TICKS},\n{fresh},\n{metrics_cte(keyed=True, src='t')}\n{keyed}, NULL AS reject_reason FROM m\n"
        f"UNION ALL SELECT seq, symbol, \"timestamp\", price, {none}, 'late_tick' FROM a WHERE late")
    q["stream_wide_frames"] = f"""WITH {TICKS},
{metrics_cte()},
m48 AS (SELECT *, coalesce(stddev_samp(log_return) OVER w48, 0.0) AS volatility_48h,
    coalesce(avg(price) OVER w48, price) AS price_ma_48h FROM m
  WINDOW w48 AS (ORDER BY "timestamp" RANGE BETWEEN 172800 PRECEDING AND CURRENT ROW))
SELECT seq, "timestamp", price, {R6('log_return')} AS log_return, {R6('volatility_1h')} AS volatility_1h,
  {R6('volatility_48h')} AS volatility_48h, {R6('price_ma_48h')} AS price_ma_48h FROM m48"""
    # without seq, ticks of a second are ordered and told apart by (datetime, price)
    plain = 'd AS (SELECT DISTINCT "timestamp", datetime, price FROM ticks)'
    q["stream_no_seq"] = (f"WITH {TICKS},\n{plain},\n{metrics_cte(src='d', seq='datetime, price')}\n"
                          + METRIC_SELECT.replace("SELECT seq,", "SELECT datetime,") + " FROM m")
    # the reference's mode: each of the four arrivals alone
    parts = ("b AS (SELECT *, (seq - (SELECT min(seq) FROM ticks)) * 4 // "
             "((SELECT max(seq) - min(seq) + 1 FROM ticks)) AS ingest_batch FROM ticks)")
    q["stream_metrics_per_batch"] = (
        f"WITH {TICKS},\n{parts},\n{metrics_cte(src='b', part='PARTITION BY ingest_batch ')}\n"
        + METRIC_SELECT.replace("SELECT seq,", "SELECT CAST(ingest_batch AS BIGINT) AS ingest_batch, seq,")
        + " FROM m")
    q["batch_job_summary"] = with_metrics(
        f"SELECT count(*) AS total_records, count(DISTINCT date) AS total_days, "
        f"count(*) FILTER (WHERE volatility_24h > {THRESHOLD}) AS spike_count, "
        f"{R6(THRESHOLD)} AS threshold, (SELECT hour_of_day FROM m GROUP BY hour_of_day "
        f"ORDER BY avg(volatility_1h) DESC, hour_of_day LIMIT 1) AS peak_hour FROM m")
    for k in ("daily_stats", "hourly_pattern", "spike_threshold", "volatility_spikes"):
        q[f"{k}_incremental"] = q[k]
    q["backfill_job"] = q["candle_metrics"]
    q["backfill_incremental"] = q["candle_metrics"]
    q["candle_gaps"] = f"""WITH {TICKS},
s AS (SELECT min(seq) AS least, max(seq) - min(seq) + 1 AS n FROM ticks),
h AS (SELECT min("timestamp") // 3600 * 3600 AS half FROM ticks, s WHERE (seq - least) * 2 // n >= 1),
c AS (
  SELECT DISTINCT symbol, "timestamp" // 3600 * 3600 AS t, 1 AS poll FROM ticks, s WHERE (seq - least) * 5 // n < 3
  UNION ALL SELECT DISTINCT symbol, "timestamp" // 3600 * 3600, 2 FROM ticks, h WHERE "timestamp" >= half),
g AS (SELECT symbol, t, count(*) AS n FROM c GROUP BY symbol, t),
o AS (SELECT *, lead(t) OVER (PARTITION BY symbol ORDER BY t) AS next FROM g),
r AS (SELECT symbol, t, n, t - 3600 * row_number() OVER (PARTITION BY symbol ORDER BY t) AS island FROM g WHERE n > 1),
f AS (SELECT symbol, 'missing' AS kind, t + 3600 AS first, next - 3600 AS last, (next - t) // 3600 - 1 AS candles
      FROM o WHERE next - t > 3600
      UNION ALL SELECT symbol, 'repeated', min(t), max(t), CAST(sum(n - 1) AS BIGINT) FROM r GROUP BY symbol, island)
SELECT 'S' || CAST(symbol AS VARCHAR) AS symbol, 'hourly' AS interval, kind, first, last, candles FROM f"""
    q["quote_job"] = f"""WITH {QUOTES}
SELECT seq, "timestamp", datetime, symbol, price, open24h, supply FROM q WHERE price > 0"""
    q["spike_threshold_approx"] = "SELECT true AS rank_within_error"
    # a message is its text and a line end
    q["volume_audit"] = f"""WITH v AS (SELECT CAST(sum(strlen(value) + 1) AS BIGINT) AS total_bytes
  FROM ({q['tick_serialize']}))
SELECT true AS all_hours, total_bytes, total_bytes >= 3.0 * 1024 ** 3 AS meets_minimum,
  {R6('greatest(3.0 - total_bytes / 1024.0 ** 3, 0.0)')} AS shortfall_gb FROM v"""
    q["history_merge"] = f"""WITH {TICKS},
s AS (SELECT min(seq) AS least, max(seq) - min(seq) + 1 AS n FROM ticks),
h AS (SELECT min("timestamp") // 3600 * 3600 AS half FROM ticks, s WHERE (seq - least) * 2 // n >= 1),
late AS (SELECT ticks.* FROM ticks, h WHERE "timestamp" >= half),
c AS (SELECT symbol, "timestamp" // 3600 * 3600 AS t, arg_max(price, row("timestamp", seq)) AS price
  FROM ticks, s WHERE (seq - least) * 5 // n < 3 GROUP BY ALL)
SELECT 'stream' AS source, "timestamp", datetime, date, 'S' || CAST(symbol AS VARCHAR) AS symbol,
  NULL::VARCHAR AS interval, price FROM late
UNION ALL
SELECT 'bulk', t, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ'), CAST(make_timestamp(t * 1000000) AS DATE),
  'S' || CAST(symbol AS VARCHAR), 'hourly', price
FROM c WHERE NOT EXISTS (SELECT 1 FROM late WHERE late.symbol = c.symbol AND late."timestamp" // 3600 * 3600 = c.t)"""
    return q
