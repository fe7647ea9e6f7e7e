"""BI questions over the gold marts (null order spelled out: PostgreSQL puts
NULLs last for ASC and first for DESC unless told otherwise)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.timefmt import minutes_between


def _asc(*cols: str):
    return [F.col(c).asc_nulls_last() for c in cols]


def price_comparison(cmp: DataFrame) -> DataFrame:
    return cmp.select("coin_id", "symbol", "coingecko_price_usd", "binance_price_usd", "spread_usd",
                      "spread_pct", "coingecko_at", "binance_at").orderBy(*_asc("coin_id"))


def latest_by_source(lbs: DataFrame) -> DataFrame:
    return lbs.select("coin_id", "source", "symbol", "price_usd", "change_24h",
                      "last_recorded_at").orderBy(*_asc("coin_id", "source"))


def latest_coingecko(latest: DataFrame) -> DataFrame:
    return latest.select("coin_id", "symbol", "price_usd", "market_cap", "change_24h",
                         "last_recorded_at").orderBy(*_asc("coin_id"))


def daily_avg(daily: DataFrame) -> DataFrame:
    return daily.select("price_date", "coin_id", "source", "avg_price_usd").orderBy(
        *_asc("price_date", "coin_id", "source"))


def spread_ranking(cmp: DataFrame) -> DataFrame:
    return cmp.select("coin_id", "symbol", "spread_pct", "spread_usd").orderBy(F.col("spread_pct").desc_nulls_last())


def zone_volume(zv: DataFrame) -> DataFrame:
    return zv.select("zone", "source", "row_count").orderBy(*_asc("zone", "source"))


def sanity(s: DataFrame) -> DataFrame:
    return s.select("mart", "total_rows", "null_prices", "non_positive_prices")


def freshness(fr: DataFrame) -> DataFrame:
    return fr.select("source", "last_event_at", "minutes_stale", "sla_status").orderBy(*_asc("source"))


def source_gap(cmp: DataFrame) -> DataFrame:
    """Signed minutes feed A minus feed B, rounded to 0.1."""
    return cmp.select(
        "coin_id", "coingecko_at", "binance_at",
        F.round(minutes_between(F.col("coingecko_at"), F.col("binance_at")), 1).alias("coingecko_minus_binance_minutes"),
    ).orderBy(*_asc("coin_id"))


def ops_latest(latest: DataFrame) -> DataFrame:
    """The ops dashboard's latest-price table."""
    return latest.select("coin_id", "price_usd", "change_24h", "last_recorded_at").orderBy(*_asc("coin_id"))


QUESTIONS = {
    "price_comparison": ("comparison", price_comparison),
    "latest_by_source": ("latest_by_source", latest_by_source),
    "latest_coingecko": ("latest", latest_coingecko),
    "daily_avg": ("daily", daily_avg),
    "spread_ranking": ("comparison", spread_ranking),
    "zone_volume": ("zone_volume", zone_volume),
    "sanity": ("sanity", sanity),
    "freshness": ("freshness", freshness),
    "source_gap": ("comparison", source_gap),
    "ops_latest": ("latest", ops_latest),
}


def bi(name: str, gold: dict[str, DataFrame]) -> DataFrame:
    """Answer BI question ``name`` from a dict of gold marts."""
    mart, fn = QUESTIONS[name]
    return fn(gold[mart])
