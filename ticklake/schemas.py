"""Declared schemas, keys and domain constants.

Schemas are fixed and declared here; nothing in the library infers a schema
from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's domain for identical results) ---
# tracked coins, in natural order
TRACKED_COINS = ("bitcoin", "ethereum", "solana")
# accepted sources
SOURCES = ("coingecko", "binance")
# feed A: coin id -> symbol
COIN_SYMBOLS = {"bitcoin": "btc", "ethereum": "eth", "solana": "sol"}
# feed B: exchange pair -> (coin id, symbol)
PAIR_TO_COIN = {
    "BTCUSDT": ("bitcoin", "btc"),
    "ETHUSDT": ("ethereum", "eth"),
    "SOLUSDT": ("solana", "sol"),
}
# log topics (their names are the dead letters' source_topic values) and the
# default dead-letter topic (a deployment setting; no result depends on it)
TOPIC_SNAPSHOTS = "coingecko.prices.raw"
TOPIC_TRADES = "binance.trades.raw"
TOPIC_DLQ = "prices.dead-letter"
# event contract: required keys and all allowed keys, in schema order
CONTRACT_REQUIRED = ("coin_id", "symbol", "price_usd", "event_time", "source")
CONTRACT_FIELDS = ("coin_id", "symbol", "price_usd", "market_cap", "change_24h", "event_time", "source")
SYMBOL_MIN_LEN = 2
SYMBOL_MAX_LEN = 8
# dead-letter reasons, in evaluation order
REASON_NO_COIN = "invalid_json_or_missing_coin_id"
REASON_BAD_PRICE = "missing_or_invalid_price_usd"
REASON_NO_TIME = "missing_event_time"
# extra reason of the default (non-compat) mode: time present but unparseable
REASON_BAD_TIME = "unparseable_event_time"
# dead-letter monitor reasons
REASON_UNDECODABLE = "dlq_message_undecodable"
REASON_NOT_OBJECT = "dlq_message_not_an_object"
# event-time text: trailing offset pattern and the parse pattern
OFFSET_SUFFIX = r"([+-][0-9]{2}:[0-9]{2})$"
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# freshness labels (minutes) of the mart, the quality check and the alert
FRESH_OK_MINUTES = 10
FRESH_WARN_MINUTES = 30
CHECK_FRESHNESS_MINUTES = 10
ALERT_POLL_STALE_SECONDS = 300
MIN_ROWS_PER_SOURCE = 1
# stream settings
WATERMARK_DELAY = "15 seconds"
COMMIT_DELAY = "1 minute"
CHECKPOINT_INTERVAL = "30 seconds"
# --- end of fixed values ---

KEY = ("coin_id", "source", "recorded_at")

EVENT = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price_usd", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("change_24h", T.DoubleType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("source", T.StringType()),
])

RAW = T.StructType([
    T.StructField("coin_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("symbol", T.StringType()),
    T.StructField("price_usd", T.DecimalType(20, 8)),
    T.StructField("market_cap", T.DecimalType(30, 2)),
    T.StructField("change_24h", T.DecimalType(10, 4)),
    T.StructField("recorded_at", T.TimestampNTZType(), False),
    T.StructField("ingested_at", T.TimestampNTZType(), False),
])

LAKE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price_usd", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("change_24h", T.DoubleType()),
    T.StructField("recorded_at", T.TimestampNTZType()),
    T.StructField("source", T.StringType()),
    T.StructField("coin_id", T.StringType()),
    T.StructField("dt", T.StringType()),
])
LAKE_PARTITIONS = ("source", "coin_id", "dt")

SILVER = T.StructType([f for f in RAW.fields if f.name != "ingested_at"])

DLQ = T.StructType([
    T.StructField("source_topic", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("failed_at", T.TimestampNTZType()),
])

LOG = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

PRICE = T.DecimalType(20, 8)
CAP = T.DecimalType(30, 2)
CHANGE = T.DecimalType(10, 4)
SPREAD = T.DecimalType(21, 8)
