"""Backfill and migration jobs: legacy copy, key widening, demo history grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefmt import as_column, micros
from ticklake.operators.checks import run_checks, unique
from ticklake.operators.sinks import insert_if_absent
from ticklake.schemas import CAP, CHANGE, PRICE

RAW_COLUMNS = ("coin_id", "source", "symbol", "price_usd", "market_cap", "change_24h", "recorded_at")


def copy_legacy(legacy: DataFrame, zone: DataFrame | None, *, source: str | None = "coingecko") -> DataFrame:
    """Rows of a legacy single-feed table to insert into the zone table:
    stamped with ``source`` and skipped where the key already exists. With
    ``source=None`` the key is (coin_id, recorded_at) (pre-source schema)."""
    key = ["coin_id", "recorded_at"] if source is None else ["coin_id", "source", "recorded_at"]
    rows = legacy if source is None else legacy.withColumn("source", F.lit(source))
    cols = [c for c in RAW_COLUMNS if c in rows.columns]
    return insert_if_absent(zone.select(*cols) if zone is not None else None, rows.select(*cols), key)


def add_source_column(df: DataFrame, *, default: str = "coingecko", key: Sequence[str] = ("coin_id", "source", "recorded_at")):
    """Add/fill ``source`` with a default and check the widened key is unique.
    Returns (table, check result frame)."""
    out = df if "source" in df.columns else df.withColumn("source", F.lit(None).cast("string"))
    out = out.withColumn("source", F.coalesce(F.col("source"), F.lit(default)))
    return out, run_checks(out, "migration", [unique(*key)])


def history_grid(spark_or_df, as_of, *, days: int = 7, end_hours: int = 2,
                 coins: Sequence[tuple[str, str, float, float]] | None = None,
                 sources: Sequence[tuple[str, float]] | None = None) -> DataFrame:
    """Hourly demo history: spine (as_of - days .. as_of - end_hours, 1 h) x
    coins x sources, prices from a slow and a fast sine swing plus a per-source
    offset; feed B gets no cap/change. The swing is cut to fifteen digits and what
    follows is whole-number arithmetic, so any engine gets the same digits. Base
    prices and caps are whole numbers."""
    # fixed values: demo coins (id, symbol, base price, base market cap) and source offsets
    coins = coins or [("bitcoin", "btc", 60000.0, 1200000000000.0),
                      ("ethereum", "eth", 1600.0, 200000000000.0),
                      ("solana", "sol", 75.0, 35000000000.0)]
    sources = sources or [("coingecko", 0.0), ("binance", 0.0012)]
    spark: SparkSession = getattr(spark_or_df, "sparkSession", spark_or_df)
    start = as_column(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    stop = as_column(as_of) - F.expr(f"INTERVAL {int(end_hours)} HOURS")
    spine = spark.range(1).select(F.explode(F.sequence(start, stop, F.expr("INTERVAL 1 HOUR"))).alias("recorded_at"))
    # the key grid is spine x coins x sources: generated with explode, no join
    coin_arr = F.array(*[F.struct(F.lit(a).alias("coin_id"), F.lit(b).alias("symbol"), F.lit(p).alias("base_price"),
                                  F.lit(m).alias("base_market_cap")) for a, b, p, m in coins])
    src_arr = F.array(*[F.struct(F.lit(a).alias("source"), F.lit(o).alias("source_offset")) for a, o in sources])
    grid = (spine.select("recorded_at", F.explode(coin_arr).alias("c"))
                 .select("recorded_at", "c.*", F.explode(src_arr).alias("s"))
                 .select("*", "s.*").drop("s"))
    ep = micros(F.col("recorded_at")) / F.lit(1_000_000.0)
    n = F.length("coin_id").cast("double")
    factor = (F.lit(1.0) + F.lit(0.05) * F.sin(ep / 86400.0 * 1.8 + n)
              + F.lit(0.01) * F.sin(ep / 3600.0 * 0.7 + n * 2) + F.col("source_offset"))
    cg = F.col("source") == "coingecko"
    # from here on whole numbers: the swing in units of 1e-15, products rounded half away from zero
    grid = grid.withColumns({"_f": F.floor(factor * 1e15).cast("decimal(17,0)"), "_p": F.col("base_price").cast("decimal(13,0)"),
                             "_c": F.col("base_market_cap").cast("decimal(14,0)")})
    change = F.expr("sign(_f - 1000000000000000) * ((abs(_f - 1000000000000000) + 500000000) div 1000000000)")
    return grid.select(
        "coin_id", "source", "symbol",
        (F.expr("(_p * _f + 5000000) div 10000000").cast("decimal(18,0)") * F.expr("0.00000001BD")).cast(PRICE).alias("price_usd"),
        F.when(cg, (F.expr("(_c * _f + 5000000000000) div 10000000000000").cast("decimal(20,0)") * F.expr("0.01BD")).cast(CAP)).alias("market_cap"),
        F.when(cg, (change.cast("decimal(18,0)") * F.expr("0.0001BD")).cast(CHANGE)).alias("change_24h"),
        F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"),
    )
