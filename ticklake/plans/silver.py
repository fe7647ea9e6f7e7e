"""Silver zone: staging view and the deduplicated incremental table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ticklake.functions.timefmt import as_column
from ticklake.operators import tables as TB
from ticklake.operators.keyed import dedupe_by_key
from ticklake.schemas import CAP, CHANGE, KEY, PRICE, RAW
from ticklake.session import folders

SILVER_COLUMNS = ("coin_id", "source", "symbol", "price_usd", "market_cap", "change_24h", "recorded_at")
# distinct-on tie-break: the rows of one key are ordered by these, NULLs last
TIE_BREAK = ("price_usd", "symbol", "market_cap", "change_24h")


def source_columns(raw: DataFrame) -> list[str]:
    """Columns of a raw table beyond the declared ones: what its source has gained."""
    return [c for c in raw.columns if c not in (*RAW.names, "dt")]


def stg_prices(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Typed, trimmed, lower-cased ticks with a positive price and a full key, and the
    ``extra`` columns as they are. No deduplication."""
    price = F.col("price_usd")
    cond = (F.col("coin_id").isNotNull() & F.col("source").isNotNull() & price.isNotNull()
            & (price > 0) & F.col("recorded_at").isNotNull())
    if isinstance(raw.schema["price_usd"].dataType, (DoubleType, FloatType)):
        cond = cond & ~F.isnan(price)  # NaN > 0 is true in Spark
    return raw.where(cond).select(
        "coin_id",
        F.lower(F.trim("source")).alias("source"),
        F.lower(F.trim("symbol")).alias("symbol"),
        price.cast(PRICE).alias("price_usd"),
        F.col("market_cap").cast(CAP).alias("market_cap"),
        F.col("change_24h").cast(CHANGE).alias("change_24h"),
        F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"), *extra,
    )


def _dedupe(stg: DataFrame) -> DataFrame:
    extra = [c for c in stg.columns if c not in SILVER_COLUMNS]
    return dedupe_by_key(stg, KEY, TIE_BREAK, extra).select(*SILVER_COLUMNS, *extra)


def clean_prices(stg: DataFrame, existing: DataFrame | None = None, *,
                 hwm_by: Sequence[str] = (), lookback_seconds: int | None = None) -> DataFrame:
    """The silver table after one run.

    ``existing=None`` is a full refresh: staging deduplicated on
    (coin_id, source, recorded_at). Otherwise an incremental run: only staging
    rows strictly newer than the high-water mark of ``existing`` are taken
    (global by default; per ``hwm_by`` columns if given; minus
    ``lookback_seconds``), deduplicated, and merged by key (new rows replace
    old rows of the same key). Columns are synced to the new schema;
    ``refresh_silver`` does the same to a written table.
    """
    if existing is None:
        return _dedupe(stg)
    new = new_rows(stg, existing, hwm_by=hwm_by, lookback_seconds=lookback_seconds)
    kept = existing.join(new.select(*KEY), on=list(KEY), how="left_anti")
    merged = kept.unionByName(new, allowMissingColumns=True)
    return merged.select(*new.columns)


def high_water(spark: SparkSession, path: str):
    """Newest ``recorded_at`` of the written silver table, as a value. Only the newest day
    that has rows can hold it, and days come from the store's listing."""
    table = TB.read_table(spark, path)
    for day in sorted((f.removeprefix("dt=") for f in folders(spark, path) if f.startswith("dt=") and not f.endswith("_PARTITION__")), reverse=True):
        value = table.where(F.col("dt") == day).agg(F.max("recorded_at")).first()[0]
        if value is not None:
            return value
    return None


def refresh_silver(spark: SparkSession, stg: DataFrame, path: str, *, full_refresh: bool = False) -> DataFrame:
    """Bring the written silver table up to date with staging and read it (action).

    A first or full run writes it whole; an incremental run upserts the rows
    newer than the high-water mark into the day partitions they touch. The
    table's columns follow staging's, in every partition: a new column is NULL
    in older rows, a column that staging lost is dropped from the table.
    """
    from ticklake.operators import sinks as SK

    def by_day(df: DataFrame) -> DataFrame:
        return df.withColumn("dt", F.date_format("recorded_at", "yyyy-MM-dd"))

    if full_refresh or not SK.table_exists(spark, path):
        rows = by_day(clean_prices(stg))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dt").parquet(path)
        TB.declare(spark, path, rows.schema)
    else:
        new = new_rows(stg, TB.read_table(spark, path), since=high_water(spark, path))
        SK.upsert_by_key(by_day(new), path, list(KEY), ["recorded_at"], keep_first=(), sync=True)
    return TB.read_table(spark, path).drop("dt")


def new_rows(stg: DataFrame, existing: DataFrame, *, hwm_by: Sequence[str] = (),
             lookback_seconds: int | None = None, since=None) -> DataFrame:
    """The deduplicated staging rows an incremental run adds or replaces; ``since`` is the
    high-water mark where it is known already."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if since is not None:
        fresh, mark = stg, as_column(since)
    elif hwm_by:
        marks = existing.groupBy(*hwm_by).agg(F.max("recorded_at").alias("_hwm"))
        fresh = stg.join(marks, on=list(hwm_by), how="left")
        mark = F.coalesce(F.col("_hwm"), epoch)
    else:
        # evaluated once (a bounded aggregate) and used as a literal, so the
        # filter can reach the scan of the staging source
        fresh = stg
        src = existing
        if "dt" in existing.columns:
            # day-partitioned table: only the newest partition can hold the max,
            # and partition values come from the file listing
            newest = existing.agg(F.max("dt")).first()[0]
            src = existing.where(F.col("dt") == newest)
        value = src.agg(F.max("recorded_at")).first()[0]
        mark = as_column(value) if value is not None else epoch
    if lookback_seconds:
        mark = mark - F.expr(f"INTERVAL {int(lookback_seconds)} SECONDS")
    return _dedupe(fresh.where(F.col("recorded_at") > mark).select(*stg.columns))
