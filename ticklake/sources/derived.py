"""Tick inputs derived by Spark from the driver's tables.

The driver ships generic tables; the pipeline needs price ticks, raw log
messages, snapshot bodies and trade frames. Each is a pure projection of
``events`` (one output row per input row, plus derived copies), so its size
grows with the table and Catalyst prunes it to the columns used.

Dirt (nulls, zero and negative prices, padded upper-case sources, duplicate
keys, broken JSON) is derived from ``event_id`` arithmetic; every rule here
has a line-for-line twin in ``ticklake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefmt import to_millis
from ticklake.schemas import CAP, CHANGE, PRICE, TOPIC_SNAPSHOTS, TOPIC_TRADES

# fixture mapping: event type -> (coin id, symbol); other types stay as
# untracked coins so accepted-values checks have something to find
_EVENT_COIN = {"click": ("bitcoin", "btc"), "view": ("ethereum", "eth"), "purchase": ("solana", "sol")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(col)


def tick_base(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    return events.select(
        "event_id", "ts", "value",
        _case(et, {k: v[0] for k, v in _EVENT_COIN.items()}).alias("coin_id"),
        _case(et, {k: v[1] for k, v in _EVENT_COIN.items()}).alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, F.lit("coingecko")).otherwise(F.lit("binance")).alias("source"),
    )


def ticks(events: DataFrame) -> DataFrame:
    """Clean typed ticks: one per event (the raw table of a healthy feed)."""
    b = tick_base(events)
    coingecko = F.col("source") == "coingecko"
    return b.select(
        "coin_id", "source", "symbol",
        F.col("value").cast(PRICE).alias("price_usd"),
        F.when(coingecko, F.col("value") * 1000).cast(CAP).alias("market_cap"),
        F.when(coingecko, F.col("value") / 100).cast(CHANGE).alias("change_24h"),
        to_millis(F.col("ts")).alias("recorded_at"),
    )


def dirty_ticks(events: DataFrame) -> DataFrame:
    """Typed raw rows with dirt: the stand-in for the raw zone table."""
    b = tick_base(events)
    eid = F.col("event_id")
    coingecko = F.col("source") == "coingecko"
    one = b.select(
        "event_id",
        F.when(eid % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("coin_id")).alias("coin_id"),
        F.when(eid % 5 == 0, F.concat(F.lit(" "), F.upper("source"), F.lit(" "))).otherwise(F.col("source")).alias("source"),
        F.when(eid % 7 == 0, F.upper("symbol")).otherwise(F.col("symbol")).alias("symbol"),
        F.when(eid % 89 == 0, F.lit(None).cast("double"))
         .when(eid % 97 == 0, F.lit(0.0))
         .when(eid % 101 == 0, -F.col("value"))
         .otherwise(F.col("value")).cast(PRICE).alias("price_usd"),
        F.when(coingecko, F.col("value") * 1000).cast(CAP).alias("market_cap"),
        F.when(coingecko, F.col("value") / 100).cast(CHANGE).alias("change_24h"),
        F.when(eid % 103 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(to_millis(F.col("ts"))).alias("recorded_at"),
    )
    # replayed copies: same key, different price
    copies = one.where(eid % 50 == 0).select(
        (eid + 1_000_000).alias("event_id"), "coin_id", "source", "symbol",
        (F.col("price_usd") + 1).cast(PRICE).alias("price_usd"), "market_cap", "change_24h", "recorded_at",
    )
    return one.unionByName(copies)


def raw_log(events: DataFrame) -> DataFrame:
    """One JSON text message per event, as it would sit on a feed topic.

    Columns: event_id, feed, topic, kafka_ts, raw_value.
    """
    b = tick_base(events)
    eid = F.col("event_id")
    ts_text = F.col("ts").cast("string")
    price = (F.when(eid % 17 == 0, F.lit("null"))
              .when(eid % 19 == 0, F.lit('"n/a"'))
              .when(eid % 23 == 0, F.lit('"12.5"'))
              .when(eid % 67 == 0, F.lit('"NaN"'))       # a double, but no price
              .when(eid % 71 == 0, F.lit('"1e30"'))      # beyond the raw table's type
              .when(eid % 2 == 0, (eid % 500 + 1).cast("string"))
              .otherwise(F.concat((eid % 500 + 1).cast("string"), F.lit(".25"))))
    event_time = F.when(eid % 29 == 0, F.lit("")).otherwise(F.concat(
        F.lit('"event_time": "'), F.substring(ts_text, 1, 10), F.lit("T"), F.substring(ts_text, 12, 8),
        F.when(eid % 31 == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad((eid % 1_000_000).cast("string"), 6, "0"))),
        F.when(eid % 37 == 0, F.lit("Z")).when(eid % 41 == 0, F.lit("+02:00")).otherwise(F.lit("+00:00")),
        F.lit('", ')))
    obj = F.concat(
        F.lit("{"),
        F.when(eid % 13 == 0, F.lit("")).otherwise(F.concat(F.lit('"coin_id": "'), F.col("coin_id"), F.lit('", '))),
        F.lit('"symbol": "'), F.col("symbol"), F.lit('", '),
        F.lit('"price_usd": '), price, F.lit(", "),
        event_time,
        F.lit('"market_cap": null, "change_24h": null'),
        F.when(eid % 43 == 0, F.lit("")).otherwise(F.concat(F.lit(', "source": "'), F.col("source"), F.lit('"'))),
        F.when(eid % 47 == 0, F.lit(', "extra": 1')).otherwise(F.lit("")),
        F.when(eid % 53 == 0, F.lit("")).otherwise(F.lit("}")),
    )
    raw = (F.when(eid % 61 == 0, F.lit('["late", 0, {}]'))
            .when(eid % 59 == 0, F.lit("<frame cut"))
            .otherwise(obj))
    return b.select(
        "event_id",
        F.col("source").alias("feed"),
        F.when(F.col("source") == "coingecko", F.lit(TOPIC_SNAPSHOTS)).otherwise(F.lit(TOPIC_TRADES)).alias("topic"),
        F.col("ts").alias("kafka_ts"),
        raw.alias("raw_value"),
    )


def arrivals(events: DataFrame, *, copies: bool = False) -> DataFrame:
    """The feed log's records with ``arrival``, the order in which they reach the landing place:
    every 37th a tenth of the log later than its position says, every 41st half of the log later;
    with ``copies`` every 50th a second time, a twentieth of the log later."""
    from ticklake.sources.log import log_records
    last = events.agg(F.max("event_id")).first()[0]
    n = (last if last is not None else 0) + 1
    one = log_records(raw_log(events))
    delay = F.when(F.col("offset") % 41 == 0, F.lit(n // 2)).when(F.col("offset") % 37 == 0, F.lit(n // 10)).otherwise(F.lit(0))
    out = one.withColumn("arrival", F.col("offset") + delay)
    if copies:
        out = out.unionByName(one.where(F.col("offset") % 50 == 0).withColumn("arrival", F.col("offset") + F.lit(n // 20)))
    return out


def snapshot_bodies(events: DataFrame) -> DataFrame:
    """Feed-A poll bodies: ``{coin: {usd, usd_market_cap, usd_24h_change}, ...}``.

    Each event is one poll holding its own coin and a stable-coin entry;
    some polls lack ``usd`` (skipped), carry ``usd = 0`` (contract failure)
    or an untracked coin (symbol falls back to the id, then fails).
    Columns: poll_id, received_at, payload.
    """
    b = tick_base(events)
    eid = F.col("event_id")
    usd = (F.when(eid % 11 == 0, F.lit(""))
            .when(eid % 13 == 0, F.lit('"usd": 0, '))
            .otherwise(F.concat(F.lit('"usd": '), F.format_string("%.2f", F.col("value")), F.lit(", "))))
    coin_entry = F.concat(
        F.lit('"'), F.col("coin_id"), F.lit('": {'), usd,
        # now and then a quoted cap or a boolean change
        F.lit('"usd_market_cap": '), F.when(eid % 31 == 0, F.lit('"12"')).otherwise(F.format_string("%.2f", F.col("value") * 1000)),
        F.lit(', "usd_24h_change": '), F.when(eid % 3 == 0, F.lit("null")).when(eid % 37 == 0, F.lit("true")).otherwise(F.format_string("%.6f", F.col("value") / 100)),
        F.lit("}"))
    stable = F.concat(F.lit(', "tether": {"usd": 1.0, "usd_market_cap": null, "usd_24h_change": '),
                      (eid % 7).cast("string"), F.lit("}"))
    return b.select(
        F.col("event_id").alias("poll_id"),
        F.col("ts").alias("received_at"),
        F.concat(F.lit("{"), coin_entry, stable, F.lit("}")).alias("payload"),
    )


def hourly_bodies(events: DataFrame) -> DataFrame:
    """Feed-A polls of one body an hour, over several lines: the latest value of every coin in the hour; now and then
    a coin without a price. Columns: received_at (the hour's end), payload."""
    hour = F.date_trunc("hour", F.col("ts")) + F.expr("INTERVAL 1 HOUR")
    b = tick_base(events).groupBy(hour.cast("timestamp_ntz").alias("received_at"), "coin_id").agg(
        F.max(F.struct("ts", "event_id", "value")).alias("t"))
    usd = F.when(F.col("t.event_id") % 9 == 0, F.lit("")).otherwise(F.concat(F.lit('\n    "usd": '), F.format_string("%.2f", F.col("t.value")), F.lit(",")))
    entry = F.concat(F.lit('  "'), F.col("coin_id"), F.lit('": {'), usd, F.lit('\n    "usd_market_cap": null\n  }'))
    return b.groupBy("received_at").agg(F.concat(F.lit("{\n"), F.array_join(F.sort_array(F.collect_list(entry)), ",\n"), F.lit("\n}")).alias("payload"))


def trade_frames(events: DataFrame) -> DataFrame:
    """Feed-B socket frames: ``{"e","s","p","T"}``, some wrapped as
    ``{"stream", "data"}``; with non-trade events, unknown pairs, lower-case
    pairs, missing trade time, non-numeric prices and whole-second times.
    Columns: frame_id, received_at, payload.
    """
    b = tick_base(events)
    eid = F.col("event_id")
    pair = F.concat(F.upper(F.col("symbol")), F.lit("USDT"))
    pair = F.when(eid % 7 == 0, F.lower(pair)).otherwise(pair)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    ms = F.when(eid % 9 == 0, ms - ms % 1000).otherwise(ms)
    trade = F.concat(
        F.lit('{"e": "'), F.when(eid % 11 == 0, F.lit("depthUpdate")).otherwise(F.lit("trade")),
        F.lit('", "s": "'), pair,
        F.lit('", "p": "'), F.when(eid % 17 == 0, F.lit("abc")).otherwise(F.format_string("%.2f", F.col("value"))),
        F.lit('"'),
        F.when(eid % 13 == 0, F.lit("")).when(eid % 19 == 0, F.concat(F.lit(', "T": "'), ms.cast("string"), F.lit('"')))
         .otherwise(F.concat(F.lit(', "T": '), ms.cast("string"))),
        F.lit("}"))
    wrapped = F.concat(F.lit('{"stream": "'), F.lower(pair), F.lit('@trade", "data": '), trade, F.lit("}"))
    return b.select(
        F.col("event_id").alias("frame_id"),
        F.col("ts").alias("received_at"),
        F.when(eid % 3 == 0, wrapped).otherwise(trade).alias("payload"),
    )


def ingest_log(events: DataFrame) -> DataFrame:
    """Ingest-service log: every event is one published message of its feed,
    except ``error`` events, which are errors of that feed's service.
    Columns: ts, service, kind ('published' | 'error'), coin_id, price_usd, error_type.
    """
    b = tick_base(events)
    is_err = F.col("coin_id") == "error"
    return b.select(
        "ts", F.col("source").alias("service"),
        F.when(is_err, F.lit("error")).otherwise(F.lit("published")).alias("kind"),
        F.when(~is_err, F.col("coin_id")).alias("coin_id"),
        F.when(~is_err, F.col("value")).alias("price_usd"),
        F.when(is_err, F.when(F.col("event_id") % 2 == 0, F.lit("http")).otherwise(F.lit("publish"))).alias("error_type"),
    )


def progress_log(events: DataFrame, *, trigger_minutes: int = 1) -> DataFrame:
    """Streaming-query progress: one row per trigger interval that had input
    (batch time = interval end, input rows, and a lag made from the event ids).
    Columns: batch_ts, input_rows, offsets_behind."""
    w = F.window("ts", f"{int(trigger_minutes)} minutes")
    return (events.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("input_rows"), (F.sum("event_id") % 20_000).alias("offsets_behind"))
            .select(F.col("w.end").cast("timestamp_ntz").alias("batch_ts"), "input_rows", "offsets_behind"))
