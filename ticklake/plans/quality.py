"""Quality suites: cross-zone runtime checks and declared model tests.

Every suite names a relation and its rules; ``quality_results`` runs them all
(each relation once per pass) and unions the small result frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.operators import checks as C
from ticklake.schemas import SOURCES, TRACKED_COINS

_COMMON = [C.row_count_min(1), C.not_null("coin_id"), C.not_null("price_usd"),
           C.accepted_values("coin_id", TRACKED_COINS), C.min_gt("price_usd", 0)]

# (zone, relation, rules); relations: raw_24h, silver_24h, latest_as_ts, comparison, raw, stg, clean,
# latest, latest_by_source, daily, changes
ZONE_SUITES = [
    ("raw", "raw_24h", _COMMON + [C.unique("coin_id", "source", "recorded_at"), C.accepted_values("source", SOURCES),
                                  C.not_null("recorded_at"), C.freshness("recorded_at")]),
    ("silver", "silver_24h", _COMMON + [C.unique("coin_id", "source", "recorded_at"),
                                        C.accepted_values("source", SOURCES), C.not_null("recorded_at")]),
    ("gold", "latest_as_ts", _COMMON + [C.not_null("recorded_at"), C.row_count_eq(len(TRACKED_COINS))]),
    ("gold_comparison", "comparison", [C.row_count_min(1)]),
]

MODEL_TESTS = [
    ("source:raw.crypto_prices", "raw", [
        C.not_null("coin_id"), C.accepted_values("coin_id", TRACKED_COINS), C.not_null("source"),
        C.accepted_values("source", SOURCES), C.not_null("price_usd"), C.not_null("recorded_at")]),
    ("model:stg_crypto_prices", "stg", [
        C.not_null("coin_id"), C.accepted_values("coin_id", TRACKED_COINS), C.not_null("source"),
        C.accepted_values("source", SOURCES), C.not_null("price_usd"), C.not_null("recorded_at")]),
    ("model:crypto_prices_clean", "clean", [
        C.unique("coin_id", "source", "recorded_at"), C.not_null("coin_id"), C.not_null("source"),
        C.not_null("price_usd"), C.not_null("recorded_at")]),
    ("model:mart_latest_prices", "latest", [
        C.not_null("coin_id"), C.unique("coin_id"), C.accepted_values("coin_id", TRACKED_COINS),
        C.not_null("price_usd"), C.not_null("last_recorded_at")]),
    ("model:mart_latest_prices_by_source", "latest_by_source", [
        C.unique("coin_id", "source"), C.not_null("coin_id"), C.not_null("source"),
        C.accepted_values("source", SOURCES)]),
    ("model:mart_source_price_comparison", "comparison", [
        C.not_null("coin_id"), C.unique("coin_id"), C.not_null("coingecko_price_usd"),
        C.not_null("binance_price_usd")]),
    ("model:mart_daily_prices", "daily", [C.unique("coin_id", "source", "price_date"), C.not_null("sample_count")]),
    ("model:fct_price_changes", "changes", [C.not_null("coin_id"), C.not_null("source"), C.not_null("recorded_at")]),
]


def relations(raw: DataFrame, stg: DataFrame, clean: DataFrame, gold: dict[str, DataFrame], *, as_of) -> dict[str, DataFrame]:
    """The relations the suites read; zone checks look at the last 24 h."""
    from ticklake.functions.timefmt import as_column
    since = as_column(as_of) - F.expr("INTERVAL 24 HOURS")
    return {
        "raw": raw, "stg": stg, "clean": clean,
        "raw_24h": raw.where(F.col("recorded_at") >= since),
        "silver_24h": clean.where(F.col("recorded_at") >= since),
        "latest_as_ts": gold["latest"].withColumnRenamed("last_recorded_at", "recorded_at"),
        **{k: gold[k] for k in ("latest", "latest_by_source", "comparison", "daily", "changes") if k in gold},
    }


def quality_results(rels: dict[str, DataFrame], *, as_of, suites=None) -> DataFrame:
    out = None
    for zone, rel, rules in (suites or ZONE_SUITES + MODEL_TESTS):
        r = C.run_checks(rels[rel], zone, rules, as_of=as_of)
        out = r if out is None else out.unionByName(r)
    return out


def feed_results(raw_24h: DataFrame) -> DataFrame:
    """Source volume and coin coverage as result rows of the raw zone, one per
    expected source, so that a run in which a whole feed is absent fails the gate."""
    vol = C.source_volume(raw_24h).select("zone", F.lit("source_volume").alias("check_name"), F.col("source").alias("column_name"),
                                          (~F.col("success")).cast("long").alias("failed_rows"), F.col("row_count").alias("total_rows"), "success")
    cov = C.coin_coverage(raw_24h).select("zone", F.lit("coin_coverage").alias("check_name"), F.col("source").alias("column_name"),
                                          (F.lit(len(TRACKED_COINS)) - F.col("coins_seen")).alias("failed_rows"),
                                          F.lit(len(TRACKED_COINS)).cast("long").alias("total_rows"), "success")
    return vol.unionByName(cov)
