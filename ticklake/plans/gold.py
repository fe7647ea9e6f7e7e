"""Gold zone marts over the silver table.

All ``as_of`` arguments are explicit (Column or datetime); nothing reads the
wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.numeric import pct_change, sla_status
from ticklake.functions.timefmt import as_column, minutes_between
from ticklake.operators.keyed import previous, top1_by_key
from ticklake.schemas import FRESH_OK_MINUTES, FRESH_WARN_MINUTES, SPREAD

LATEST_PAYLOAD = ("symbol", "price_usd", "market_cap", "change_24h")


def latest(clean: DataFrame, *, source: str = "coingecko", method: str = "struct") -> DataFrame:
    """Latest tick per coin of one feed (source pruned before the aggregate).
    ``method="join"`` suits a materialised silver table (see ``top1_by_key``)."""
    top = top1_by_key(clean.where(F.col("source") == source), ["coin_id"], "recorded_at", LATEST_PAYLOAD,
                      method=method)
    return top.select("coin_id", *LATEST_PAYLOAD, F.col("recorded_at").alias("last_recorded_at"))


def latest_by_source(clean: DataFrame, *, method: str = "struct") -> DataFrame:
    """Latest tick per (coin, source)."""
    top = top1_by_key(clean, ["coin_id", "source"], "recorded_at", LATEST_PAYLOAD, method=method)
    return top.select("coin_id", "source", *LATEST_PAYLOAD, F.col("recorded_at").alias("last_recorded_at"))


def comparison(lbs: DataFrame) -> DataFrame:
    """Feed A vs feed B latest price per coin, both feeds required.

    A conditional-max pivot (one aggregate, no self-join)."""
    a = F.col("source") == "coingecko"
    b = F.col("source") == "binance"
    piv = lbs.groupBy("coin_id").agg(
        F.max("symbol").alias("symbol"),
        F.max(F.when(a, F.col("price_usd"))).alias("coingecko_price_usd"),
        F.max(F.when(b, F.col("price_usd"))).alias("binance_price_usd"),
        F.max(F.when(a, F.col("last_recorded_at"))).alias("coingecko_at"),
        F.max(F.when(b, F.col("last_recorded_at"))).alias("binance_at"),
    )
    cg, bn = F.col("coingecko_price_usd"), F.col("binance_price_usd")
    return piv.where(cg.isNotNull() & bn.isNotNull()).select(
        "coin_id", "symbol", "coingecko_price_usd", "binance_price_usd", "coingecko_at", "binance_at",
        (bn - cg).cast(SPREAD).alias("spread_usd"),
        pct_change(bn, cg).alias("spread_pct"),
    )


def daily(clean: DataFrame) -> DataFrame:
    """avg / max / min / count per (coin, source, UTC day)."""
    return (clean.groupBy("coin_id", "source", F.to_date("recorded_at").alias("price_date"))
            .agg(F.round(F.avg("price_usd"), 8).cast("double").alias("avg_price_usd"),
                 F.max("price_usd").alias("max_price_usd"),
                 F.min("price_usd").alias("min_price_usd"),
                 F.count(F.lit(1)).alias("sample_count")))


def changes(clean: DataFrame, *, bucket_seconds: int | None = 3600, max_rows: int | None = None) -> DataFrame:
    """Tick-to-tick change per (coin, source): previous price, difference,
    percent. ``bucket_seconds`` splits each key's history into time buckets,
    and buckets above ``max_rows`` rows at row quantiles, so no task holds a
    whole key or a whole burst (None = one plain window)."""
    kw = {"max_rows": max_rows} if max_rows else {}
    prev = previous(clean, ["coin_id", "source"], "recorded_at", ["price_usd"], bucket_seconds=bucket_seconds, **kw)
    p, lp = F.col("price_usd"), F.col("prev_price_usd")
    return prev.select(
        "coin_id", "source", "symbol", "price_usd", "market_cap", "change_24h", "recorded_at",
        lp.alias("prev_price_usd"),
        (p - lp).cast(SPREAD).alias("price_change_usd"),
        pct_change(p, lp).alias("price_change_pct"),
    )


def zone_volume(raw: DataFrame, clean: DataFrame, lbs: DataFrame, *, as_of) -> DataFrame:
    """Rows per source in raw and silver over the 24 h before ``as_of``, and in
    the latest-by-source mart (no window). Raw groups its source as landed."""
    since = as_column(as_of) - F.expr("INTERVAL 24 HOURS")

    def counts(df: DataFrame, zone: str, windowed: bool) -> DataFrame:
        if windowed:
            df = df.where(F.col("recorded_at") >= since)
        return df.groupBy("source").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(zone).alias("zone"), "source", "row_count")

    return (counts(raw, "raw", True)
            .unionByName(counts(clean, "silver", True))
            .unionByName(counts(lbs, "gold_latest_by_source", False)))


def freshness(lbs: DataFrame, *, as_of, ok: float = FRESH_OK_MINUTES, warn: float = FRESH_WARN_MINUTES,
              roll_up: bool = False) -> DataFrame:
    """Minutes since the last tick with an SLA label. One row per
    (coin, source) like the reference mart; ``roll_up`` gives one per source."""
    src = lbs
    if roll_up:
        src = lbs.groupBy("source").agg(F.max("last_recorded_at").alias("last_recorded_at"))
    age = minutes_between(as_column(as_of), F.col("last_recorded_at"))
    return src.select(
        "source",
        F.col("last_recorded_at").alias("last_event_at"),
        F.round(age, 1).alias("minutes_stale"),
        sla_status(age, ok, warn).alias("sla_status"),
    )


def sanity(latest_df: DataFrame, comparison_df: DataFrame) -> DataFrame:
    """Row, null-price and non-positive-price counts of two marts."""
    p = F.col("price_usd")
    one = latest_df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(p.isNull()).alias("null_prices"),
        F.count_if(p <= 0).alias("non_positive_prices"),
    ).select(F.lit("mart_latest_prices").alias("mart"), "*")
    cg, bn = F.col("coingecko_price_usd"), F.col("binance_price_usd")
    two = comparison_df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(cg.isNull() | bn.isNull()).alias("null_prices"),
        F.count_if((cg <= 0) | (bn <= 0)).alias("non_positive_prices"),
    ).select(F.lit("mart_source_price_comparison").alias("mart"), "*")
    return one.union(two)
