"""Feed normalisers and the typed event parse, as native column plans.

No Python per row: payloads are parsed once into VARIANT and read with typed
extractors; symbol lookups are map literals (a fixed three-entry table, no
join, no broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions import jsonx
from ticklake.functions.contract import is_valid, typed_violations
from ticklake.functions.numeric import storable
from ticklake.functions.timefmt import epoch_ms_to_iso, iso_utc, parse_event_time, to_millis
from ticklake.schemas import COIN_SYMBOLS, PAIR_TO_COIN, PRICE

EVENT_COLUMNS = ("coin_id", "symbol", "price_usd", "market_cap", "change_24h", "event_time", "source")


def _map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def normalize_snapshot(df: DataFrame, *, payload: str = "payload", received_at: str = "received_at",
                       poll_id: str = "poll_id", symbols: dict[str, str] = COIN_SYMBOLS,
                       compat: bool = False) -> DataFrame:
    """Feed-A poll body ``{coin: {usd, usd_market_cap, usd_24h_change}}`` ->
    one EVENT per coin with ``violations``.

    Coins without ``usd`` (absent or null) are skipped; the symbol falls back
    to the coin id; ``event_time`` is the poll's receive time. ``compat``
    reproduces all-or-nothing polls: one failing event drops the poll.
    """
    entries = df.select(
        F.col(poll_id).alias("poll_id"), F.col(received_at).alias("_recv"),
        F.explode(F.from_json(F.col(payload), "map<string, variant>")).alias("coin_id", "_q"))
    usd_type = jsonx.type_of(F.col("_q"), "$.usd")
    ev = jsonx.filter_parsed(entries, usd_type.isNotNull() & (usd_type != "VOID")).select(
        "poll_id",
        "coin_id",
        F.coalesce(F.element_at(_map_literal(symbols), F.col("coin_id")), F.col("coin_id")).alias("symbol"),
        F.try_variant_get("_q", "$.usd", "double").alias("price_usd"),
        F.try_variant_get("_q", "$.usd_market_cap", "double").alias("market_cap"),
        F.try_variant_get("_q", "$.usd_24h_change", "double").alias("change_24h"),
        iso_utc(F.col("_recv")).alias("event_time"),
        F.lit("coingecko").alias("source"),
        # a quoted or boolean number is not a JSON number for the contract; cap and change may be null
        jsonx.is_number(usd_type).alias("_usd_ok"),
        *[F.coalesce(t.isNull() | (t == "VOID") | jsonx.is_number(t), F.lit(True)).alias(n)
          for n, t in (("_cap_ok", jsonx.type_of(F.col("_q"), "$.usd_market_cap")), ("_change_ok", jsonx.type_of(F.col("_q"), "$.usd_24h_change")))],
    )
    none = F.array().cast("array<string>")
    viol = F.concat(typed_violations(), *[F.when(~F.col(c), F.array(F.lit(f"{n}:type"))).otherwise(none) for c, n in
                                          (("_usd_ok", "price_usd"), ("_cap_ok", "market_cap"), ("_change_ok", "change_24h"))])
    out = ev.withColumn("violations", viol).drop("_usd_ok", "_cap_ok", "_change_ok")
    if compat:
        # a poll holds a handful of coins: a window over poll_id is a small group
        poll_ok = F.min(is_valid(F.col("violations")).cast("int")).over(Window.partitionBy("poll_id"))
        out = out.withColumn("_poll_ok", poll_ok).where(F.col("_poll_ok") == 1).drop("_poll_ok")
    return out


def unwrap(v: Column) -> Column:
    """Use ``data`` when the frame is an envelope whose ``data`` is an object."""
    inner = F.try_variant_get(v, "$.data", "variant")
    return F.when(jsonx.is_object(inner), inner).otherwise(v)


def normalize_trades(df: DataFrame, *, payload: str = "payload", frame_id: str = "frame_id",
                     pairs: dict[str, tuple[str, str]] = PAIR_TO_COIN, python_time: bool = False) -> DataFrame:
    """Feed-B trade frame -> EVENT with ``violations``; non-trade events,
    unknown pairs and frames without a trade time are dropped.

    The pair is upper-cased before lookup; the price is the decimal text
    ``p``; an unparseable price is kept as a contract failure (the row is
    rejected, the stream goes on). ``python_time`` drops a zero fraction
    from ``event_time`` like ``isoformat()``.
    """
    parsed = jsonx.with_variant(df, payload).select(F.col(frame_id).alias("frame_id"), unwrap(F.col("_v")).alias("_t"))
    t = F.col("_t")
    pair = F.upper(F.try_variant_get(t, "$.s", "string"))
    coin = F.element_at(_map_literal({k: v[0] for k, v in pairs.items()}), pair)
    sym = F.element_at(_map_literal({k: v[1] for k, v in pairs.items()}), pair)
    # a quoted trade time is no number
    ms = F.when(jsonx.is_number(jsonx.type_of(t, "$.T")), F.try_variant_get(t, "$.T", "bigint"))
    kept = parsed.select("frame_id", "_t", coin.alias("coin_id"), sym.alias("symbol"),
                         ms.alias("_ms"), F.try_variant_get(t, "$.e", "string").alias("_e"))
    kept = jsonx.filter_parsed(kept, (F.col("_e") == "trade") & F.col("coin_id").isNotNull() & F.col("_ms").isNotNull())
    ev = kept.select(
        "frame_id", "coin_id", "symbol",
        F.trim(F.try_variant_get("_t", "$.p", "string")).try_cast("double").alias("price_usd"),
        F.lit(None).cast("double").alias("market_cap"),
        F.lit(None).cast("double").alias("change_24h"),
        epoch_ms_to_iso(F.col("_ms"), python_compat=python_time).alias("event_time"),
        F.lit("binance").alias("source"),
    )
    return ev.withColumn("violations", typed_violations())


def typed_fields(v: Column, feed: Column, *, strict_fraction: bool = True) -> list[Column]:
    """The unified view's typed columns read from a parsed message ``v``
    (``_event_ts`` is the full-precision event time)."""
    return [
        jsonx.scalar_text(v, "$.coin_id").alias("coin_id"),
        F.coalesce(jsonx.scalar_text(v, "$.source"), feed).alias("source"),
        jsonx.scalar_text(v, "$.symbol").alias("symbol"),
        jsonx.scalar_double(v, "$.price_usd").alias("price_usd"),
        jsonx.scalar_double(v, "$.market_cap").alias("market_cap"),
        jsonx.scalar_double(v, "$.change_24h").alias("change_24h"),
        parse_event_time(jsonx.scalar_text(v, "$.event_time"), strict_fraction=strict_fraction).alias("_event_ts"),
    ]


def accepted(typed: DataFrame) -> DataFrame:
    """Rows the unified view keeps, in its output columns (keeps extra columns first)."""
    extra = [c for c in typed.columns if c not in (*EVENT_COLUMNS, "_event_ts", "reason", "_v")]
    good = jsonx.filter_parsed(typed, F.col("_event_ts").isNotNull() & F.col("coin_id").isNotNull()
                               & storable(F.col("price_usd"), PRICE))
    return good.select(
        *extra, "coin_id", "source", "symbol", "price_usd", "market_cap", "change_24h",
        to_millis(F.col("_event_ts")).alias("recorded_at"),
        F.date_format("_event_ts", "yyyy-MM-dd").alias("dt"),
    )


def parse_events(log: DataFrame, *, value: str = "raw_value", feed: str = "feed", strict_fraction: bool = True,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed read of JSON log messages (the unified price view).

    Missing or mistyped fields are NULL, a broken document gives no fields;
    quoted and integer numbers are accepted for doubles. ``source`` defaults
    to the feed name. Rows without a parseable event time, a coin or a price
    (one that the raw table's type can hold) are filtered. Output: coin_id, source, symbol, price_usd, market_cap,
    change_24h, recorded_at (ms), dt.
    """
    typed = jsonx.with_variant(log, value).select(
        *keep, *typed_fields(F.col("_v"), F.col(feed), strict_fraction=strict_fraction))
    return accepted(typed)


def parse_event(df: DataFrame, *, default_source: str | None = None, compat: bool = False,
                value: str = "raw_value", feed: str = "feed") -> DataFrame:
    """The unified price view of one feed's log: ``parse_events`` with the
    feed's default source given as a literal (or taken from ``feed``).

    ``compat`` changes nothing here: in both modes a time without exactly six
    fraction digits does not parse (the dead-letter side is where compat
    differs)."""
    src = df if default_source is None else df.withColumn(feed, F.lit(default_source))
    return parse_events(src, value=value, feed=feed, strict_fraction=True)
