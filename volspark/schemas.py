"""Schemas of the tick, quote and candle data, and the fixed column lists."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for the same results) ---------
# Tick message fields, in order: timestamp, datetime, price, open24h, high24h,
# low24h, volume24h, volumeto24h, change24h, changepct24h, market_cap, supply.
TICK_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("datetime", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("open24h", T.DoubleType(), True),
    T.StructField("high24h", T.DoubleType(), True),
    T.StructField("low24h", T.DoubleType(), True),
    T.StructField("volume24h", T.DoubleType(), True),
    T.StructField("volumeto24h", T.DoubleType(), True),
    T.StructField("change24h", T.DoubleType(), True),
    T.StructField("changepct24h", T.DoubleType(), True),
    T.StructField("market_cap", T.DoubleType(), True),
    T.StructField("supply", T.DoubleType(), True),
])
TICK_FIELDS = [f.name for f in TICK_SCHEMA.fields]

# Quote field -> tick field, in the order the tick message lists them.
QUOTE_TO_TICK = [
    ("PRICE", "price"),
    ("OPEN24HOUR", "open24h"),
    ("HIGH24HOUR", "high24h"),
    ("LOW24HOUR", "low24h"),
    ("VOLUME24HOUR", "volume24h"),
    ("VOLUME24HOURTO", "volumeto24h"),
    ("CHANGE24HOUR", "change24h"),
    ("CHANGEPCT24HOUR", "changepct24h"),
    ("MKTCAP", "market_cap"),
    ("SUPPLY", "supply"),
]

# Columns of the dashboard staging sink, in order.
DASHBOARD_COLUMNS = [
    "timestamp", "datetime", "event_time", "price",
    "log_return", "volatility_1h", "volatility_24h",
    "price_ma_1h", "price_ma_24h", "price_change_pct",
    "volume24h", "high24h", "low24h",
]

# Normalized candle columns, in order.
CANDLE_COLUMNS = [
    "timestamp", "datetime", "date", "symbol", "interval",
    "price", "open", "high", "low", "volume", "volumeto",
]

# Columns the batch analyses need.
ANALYSIS_REQUIRED = ["date", "event_time", "datetime", "price",
                     "volatility_1h", "volatility_24h", "volume24h", "high24h", "low24h"]

# Columns of a spike report, in order.
SPIKE_COLUMNS = ["datetime", "date", "price", "volatility_24h", "volume24h", "high24h", "low24h"]

# Spike threshold: the 99th percentile; approximate mode uses relative error 0.001.
SPIKE_PERCENTILE = 0.99
SPIKE_RELATIVE_ERROR = 0.001
TOP_SPIKES = 20
LATEST_N = 1000
HISTORY_MIN_GB = 3.0
# -----------------------------------------------------------------------------

# Text: a feed may quote its numbers; ``quote_value`` converts them.
QUOTE_FIELDS_SCHEMA = T.StructType(
    [T.StructField(q, T.StringType(), True) for q, _ in QUOTE_TO_TICK]
)

# {"Response": ..., "Message": ..., "RAW": {symbol: {currency: {PRICE: ...}}}}
QUOTE_SCHEMA = T.StructType([
    T.StructField("Response", T.StringType(), True),
    T.StructField("Message", T.StringType(), True),
    T.StructField("RAW", T.MapType(T.StringType(),
                                   T.MapType(T.StringType(), QUOTE_FIELDS_SCHEMA)), True),
])

CANDLE_RAW_SCHEMA = T.StructType([
    T.StructField("time", T.LongType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volumefrom", T.DoubleType(), True),
    T.StructField("volumeto", T.DoubleType(), True),
])

# {"Response": "Success", "Message": "", "Data": {"Data": [candle, ...]}}
CANDLE_RESPONSE_SCHEMA = T.StructType([
    T.StructField("Response", T.StringType(), True),
    T.StructField("Message", T.StringType(), True),
    T.StructField("Data", T.StructType([
        T.StructField("Data", T.ArrayType(CANDLE_RAW_SCHEMA), True),
    ]), True),
])

DASHBOARD_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("datetime", T.StringType(), True),
    T.StructField("event_time", T.TimestampType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("log_return", T.DoubleType(), True),
    T.StructField("volatility_1h", T.DoubleType(), True),
    T.StructField("volatility_24h", T.DoubleType(), True),
    T.StructField("price_ma_1h", T.DoubleType(), True),
    T.StructField("price_ma_24h", T.DoubleType(), True),
    T.StructField("price_change_pct", T.DoubleType(), True),
    T.StructField("volume24h", T.DoubleType(), True),
    T.StructField("high24h", T.DoubleType(), True),
    T.StructField("low24h", T.DoubleType(), True),
])

# Tick messages on the file/Kafka stream carry a tie-breaker ``seq`` (Kafka:
# partition/offset; test data: event_id) next to the 12 tick fields.
def stream_tick_schema(keys: dict[str, str] | None = None) -> T.StructType:
    """The stream's fields plus one per series key (name -> type, e.g. ``{"symbol": "string"}``)."""
    own = T.StructType.fromDDL(", ".join(f"`{k}` {t}" for k, t in keys.items())).fields if keys else []
    return T.StructType(STREAM_TICK_SCHEMA.fields + own)


STREAM_TICK_SCHEMA = T.StructType(TICK_SCHEMA.fields + [T.StructField("seq", T.LongType(), True)])
