"""Columns of written tables: gained, lost, dropped, of another type."""
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ticklake.operators import sinks as SK
from ticklake.operators import tables as TB
from ticklake.plans import silver as S
from ticklake.session import read_text, write_text

KEY = ["coin_id", "recorded_at"]


def batch(spark, data, extra=""):
    df = spark.createDataFrame(data, "coin_id string, recorded_at string, price_usd double, off long" + extra)
    return (df.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
            .withColumn("dt", F.date_format("recorded_at", "yyyy-MM-dd")))


def upsert(df, path, **how):
    SK.upsert_by_key(df, path, KEY, ["off"], keep_first=(), **how)


A, B, C = "2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-02 00:00:00"


def test_a_batch_that_lacks_a_stored_column_keeps_its_values(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    upsert(batch(spark, [("a", A, 1.0, 1, "x"), ("b", B, 2.0, 2, "y")], ", note string"), path)
    upsert(batch(spark, [("a", A, 9.0, 3), ("c", C, 3.0, 4)]), path)
    got = {r["coin_id"]: (r["price_usd"], r["note"]) for r in rows(TB.read_table(spark, path))}
    assert got == {"a": (9.0, "x"), "b": (2.0, "y"), "c": (3.0, None)}


def test_the_same_without_a_declaration(spark, tmp_dir):
    """A table that something else wrote takes the union of its files' columns."""
    path = f"{tmp_dir}/t"
    batch(spark, [("a", A, 1.0, 1, "x"), ("b", B, 2.0, 2, "y")], ", note string").write.partitionBy("dt").parquet(path)
    batch(spark, [("d", C, 1.0, 1)]).write.mode("append").partitionBy("dt").parquet(path)
    upsert(batch(spark, [("a", A, 9.0, 3)]), path)
    got = {r["coin_id"]: (r["price_usd"], r["note"]) for r in rows(TB.read_table(spark, path))}
    assert got == {"a": (9.0, "x"), "b": (2.0, "y"), "d": (1.0, None)}


def test_a_new_column_is_null_in_all_older_rows(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    upsert(batch(spark, [("a", A, 1.0, 1), ("b", B, 2.0, 2), ("c", C, 2.0, 2)]), path)
    upsert(batch(spark, [("b", B, 5.0, 3, 7)], ", rank int"), path)
    table = TB.read_table(spark, path)
    assert table.columns == ["coin_id", "recorded_at", "price_usd", "off", "rank", "dt"]
    assert {r["coin_id"]: r["rank"] for r in rows(table)} == {"a": None, "b": 7, "c": None}


def test_sync_drops_from_all_partitions_alike(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    upsert(batch(spark, [("a", A, 1.0, 1, "x"), ("c", C, 2.0, 2, "z")], ", note string"), path)
    upsert(batch(spark, [("b", B, 2.0, 3)]), path, sync=True)
    assert "note" not in TB.read_table(spark, path).columns
    assert json.loads(read_text(spark, f"{path}/{TB.LEDGER}"))["dropped"] == ["note"]
    # it comes back without its old values, those in partitions that were not rewritten included
    upsert(batch(spark, [("b", "2024-01-03 00:00:00", 2.0, 4, "new")], ", note string"), path, sync=True)
    assert sorted(str(r["note"]) for r in rows(TB.read_table(spark, path))) == ["None", "None", "None", "new"]
    assert json.loads(read_text(spark, f"{path}/{TB.LEDGER}"))["dropped"] == []


def test_another_type_fails_and_changes_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    upsert(batch(spark, [("a", A, 1.0, 1, "x")], ", note string"), path)
    with pytest.raises(TB.ColumnTypeError, match="note: string is stored, int comes"):
        upsert(batch(spark, [("a", A, 2.0, 2, 5)], ", note int"), path)
    assert [(r["price_usd"], r["note"]) for r in rows(TB.read_table(spark, path))] == [(1.0, "x")]


def test_merge_plan_keeps_absent_columns(spark):
    old = batch(spark, [("a", A, 1.0, 1, "x"), ("b", B, 2.0, 2, "y")], ", note string")
    new = batch(spark, [("a", A, 9.0, 3, 1)], ", rank int")
    got = {r["coin_id"]: (r["price_usd"], r["note"], r["rank"]) for r in rows(SK.merge_by_key(old, new, KEY, ["off"], keep_first=()))}
    assert got == {"a": (9.0, "x", 1), "b": (2.0, "y", None)}


def test_small_files_are_replaced_whole(spark, tmp_dir):
    for text in ("one", "", "zwei   é"):
        write_text(spark, f"{tmp_dir}/f", text)
        assert read_text(spark, f"{tmp_dir}/f") == text


def test_high_water_mark_reads_the_newest_day(spark, tmp_dir):
    """The mark comes from one partition, found by listing; empty days are passed over."""
    path = f"{tmp_dir}/silver"
    stg = S.stg_prices(batch(spark, [("bitcoin", f"2024-01-{d:02d} 10:00:00", 1.0, d) for d in range(1, 20)]).select(
        "coin_id", F.lit("binance").alias("source"), F.lit("btc").alias("symbol"), "price_usd", F.lit(None).cast("double").alias("market_cap"),
        F.lit(None).cast("double").alias("change_24h"), "recorded_at"))
    S.refresh_silver(spark, stg, path)
    day = TB.read_table(spark, path).where(F.col("dt") == "2024-01-19")
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()
    # what older days hold isn't read: their files may even be broken
    for f in glob.glob(f"{path}/dt=2024-01-0*/*.parquet"):
        with open(f, "wb") as broken:
            broken.write(b"no parquet")
    os.mkdir(f"{path}/dt=2024-01-20")
    assert str(S.high_water(spark, path)) == "2024-01-19 10:00:00"


def test_full_refresh_leaves_no_older_days(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    def stg(days):
        return S.stg_prices(batch(spark, [("bitcoin", f"2024-01-{d:02d} 10:00:00", 1.0, d) for d in days]).select(
            "coin_id", F.lit("binance").alias("source"), F.lit("btc").alias("symbol"), "price_usd", F.lit(None).cast("double").alias("market_cap"),
            F.lit(None).cast("double").alias("change_24h"), "recorded_at"))
    S.refresh_silver(spark, stg(range(1, 9)), path)
    assert S.refresh_silver(spark, stg(range(5, 7)), path, full_refresh=True).count() == 2
