"""Sinks: keyed upsert (replay no-op, first ingested_at kept), lake append
replay, compaction, insert-if-absent, backfills."""
import datetime as dt
import math

from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL, rows
from ticklake.operators import backfill as BF
from ticklake.operators import sinks as SK
from ticklake.operators.normalize import parse_events
from ticklake.sources import derived as D

KEY = ["coin_id", "source", "recorded_at"]


def _batch(spark, data, ingested):
    df = spark.createDataFrame(data, "coin_id string, source string, price_usd double, recorded_at string, off long")
    return (df.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
              .withColumn("dt", F.date_format("recorded_at", "yyyy-MM-dd"))
              .withColumn("ingested_at", F.lit(ingested).cast("timestamp_ntz")))


def test_upsert_last_write_wins_keeps_first_ingested_at_and_replay_is_noop(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    b0 = _batch(spark, [("bitcoin", "binance", 1.0, "2024-01-01 00:00:00", 1),
                        ("bitcoin", "binance", 2.0, "2024-01-01 00:00:00", 2),
                        ("solana", "binance", 5.0, "2024-01-02 00:00:00", 3)], "2024-01-03 00:00:00")
    SK.upsert_by_key(b0, path, KEY, ["off"])
    b1 = _batch(spark, [("bitcoin", "binance", 9.0, "2024-01-01 00:00:00", 4)], "2024-01-04 00:00:00")
    SK.upsert_by_key(b1, path, KEY, ["off"])
    SK.upsert_by_key(b0, path, KEY, ["off"])
    got = {r["coin_id"]: r for r in rows(spark.read.parquet(path))}
    assert got["bitcoin"]["price_usd"] == 9.0
    assert str(got["bitcoin"]["ingested_at"]) == "2024-01-03 00:00:00"
    assert got["solana"]["price_usd"] == 5.0 and len(got) == 2


def test_upsert_filters_touched_partitions_by_literals(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    SK.upsert_by_key(_batch(spark, [("bitcoin", "binance", 1.0, f"2024-01-{d:02d} 00:00:00", d) for d in range(1, 9)], "2024-02-01 00:00:00"), path, KEY, ["off"])
    read = spark.read.parquet(path).where(SK.touched_filter([("2024-01-02",), ("2024-01-03",)], ["dt"]))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [dt" in plan and "2024-01-02" in plan
    assert {r.dt for r in read.select("dt").collect()} == {"2024-01-02", "2024-01-03"}


def test_upsert_rows_without_a_partition_value(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    b = _batch(spark, [("bitcoin", "binance", 1.0, None, 1), ("solana", "binance", 2.0, "2024-01-02 00:00:00", 2)], "2024-02-01 00:00:00")
    SK.upsert_by_key(b, path, KEY, ["off"])
    SK.upsert_by_key(b.withColumn("off", F.col("off") + 10), path, KEY, ["off"])
    assert spark.read.parquet(path).where("coin_id = 'solana'").first().off == 12


def test_lake_replay_and_lake_at_least_raw(spark, tmp_dir):
    u = parse_events(D.raw_log(D.table(spark, SF_SMALL, "events")))
    lake = f"{tmp_dir}/lake"
    SK.append_lake(u, lake, 0)
    SK.append_lake(u, lake, 0)
    SK.append_lake(u.limit(5), lake, 1)
    back = SK.read_lake(spark, lake)
    assert back.count() == u.count() + 5
    assert dict(back.dtypes)["dt"] == "string"
    raw = f"{tmp_dir}/raw"
    SK.upsert_by_key(u.withColumn("ingested_at", F.lit(None).cast("timestamp_ntz")), raw, KEY, ["recorded_at"])
    assert back.count() >= spark.read.parquet(raw).count()


def test_compaction_keeps_rows(spark, tmp_dir):
    u = parse_events(D.raw_log(D.table(spark, SF_SMALL, "events")))
    lake = f"{tmp_dir}/lake"
    SK.append_lake(u, lake, 0)
    SK.append_lake(u, lake, 1)
    r = SK.read_lake(spark, lake).select("source", "coin_id", "dt").first()
    before = SK.read_lake(spark, lake).count()
    SK.compact_lake(spark, lake, r.source, r.coin_id, r.dt)
    assert SK.read_lake(spark, lake).count() == before
    SK.compact_days(spark, lake, days=1)
    assert SK.read_lake(spark, lake).count() == before
    inv = SK.lake_inventory(spark, lake, last=1000)
    assert inv.where(F.col("partition") == f"source={r.source}/coin_id={r.coin_id}/dt={r.dt}").count() == 1


def test_compaction_of_all_days_in_one_write(spark, tmp_dir):
    u = parse_events(D.raw_log(D.table(spark, SF_SMALL, "events")), keep=("event_id",))
    lake = f"{tmp_dir}/lake"
    SK.append_lake(u, lake, 0)
    SK.append_lake(u, lake, 1)  # each row twice
    SK.compact_days(spark, lake, days=None, ids=("event_id",))
    levels = spark.read.parquet(lake).select("source", "coin_id", "dt", "batch").distinct()
    assert levels.count() == levels.select("source", "coin_id", "dt").distinct().count() == u.select("source", "coin_id", "dt").distinct().count()
    assert levels.select("batch").distinct().count() == 1
    cols = [c for c in u.columns if c in SK.read_lake(spark, lake).columns]
    assert SK.read_lake(spark, lake).select(*cols).exceptAll(u.select(*cols)).isEmpty() and SK.read_lake(spark, lake).count() == u.count()


def test_lake_compaction_query_leaves_one_level_a_day(spark, monkeypatch):
    import __spark_entry__ as E
    paths, append = set(), SK.append_lake
    monkeypatch.setattr(SK, "append_lake", lambda df, path, *a, **k: paths.add(path) or append(df, path, *a, **k))
    E.queries()["lake_compaction"](spark, SF_SMALL).count()
    lake = spark.read.parquet(*paths)
    assert lake.groupBy("source", "coin_id", "dt").agg(F.countDistinct("batch").alias("n")).where("n > 1").isEmpty()


def test_filter_of_many_partitions_is_not_a_deep_chain(spark):
    """Thousands of (source, coin, day) values, nulls among them, select just their rows."""
    values = [(f"s{k % 3}", None if k % 7 == 0 else f"c{k % 50}", None if k % 11 == 0 else f"d{k}") for k in range(3000)]
    cond = SK.touched_filter(values[::2], ("a", "b", "c"))
    df = spark.createDataFrame(values, "a string, b string, c string")
    want = sorted(map(str, (v for v in values if v in set(values[::2]))))
    assert sorted(str(tuple(r)) for r in df.where(cond).collect()) == want


def test_lake_queries_parse_the_log_once(spark, monkeypatch):
    """The batches are cut from the written records: none of them parses the log again."""
    import __spark_entry__ as E
    plans, append = [], SK.append_lake
    def seen(df, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        append(df, *a, **k)
    monkeypatch.setattr(SK, "append_lake", seen)
    E.queries()["lake_rows"](spark, SF_SMALL)
    assert len(plans) == 5 and not any("parseJson" in p for p in plans)


def test_insert_if_absent_first_wins_and_skips_conflicts(spark):
    ex = spark.createDataFrame([("a", 1)], "k string, v long")
    b = spark.createDataFrame([("a", 5), ("b", 3), ("b", 2)], "k string, v long")
    assert rows(SK.insert_if_absent(ex, b, ["k"], ["v"])) == [{"k": "b", "v": 2}]


def test_history_grid_matches_python(spark):
    as_of = dt.datetime(2024, 1, 31, 12, 30, 15, 123456)
    grid = rows(BF.history_grid(spark, as_of), ["coin_id", "source", "recorded_at"])
    assert len(grid) == 167 * 3 * 2
    base = {"bitcoin": (60000.0, 1.2e12), "ethereum": (1600.0, 2e11), "solana": (75.0, 3.5e10)}
    off = {"coingecko": 0.0, "binance": 0.0012}
    for r in grid[::37]:
        ep = (r["recorded_at"] - dt.datetime(1970, 1, 1)).total_seconds()
        n = len(r["coin_id"])
        f = 1 + 0.05 * math.sin(ep / 86400.0 * 1.8 + n) + 0.01 * math.sin(ep / 3600.0 * 0.7 + n * 2) + off[r["source"]]
        assert abs(float(r["price_usd"]) - base[r["coin_id"]][0] * f) < 1e-6
        if r["source"] == "binance":
            assert r["market_cap"] is None and r["change_24h"] is None
        else:
            assert abs(float(r["market_cap"]) - base[r["coin_id"]][1] * f) < 0.02


def test_legacy_copy_without_source_uses_two_column_key(spark):
    zone = D.ticks(D.table(spark, SF_SMALL, "events"))
    legacy = zone.drop("source")
    rows_in = BF.copy_legacy(legacy, zone.drop("source"), source=None)
    assert rows_in.count() == 0
    stamped = BF.copy_legacy(legacy, zone)
    assert stamped.where(F.col("source") != "coingecko").count() == 0


def test_add_source_column_checks_widened_key(spark):
    df = spark.createDataFrame([("bitcoin", None, "2024-01-01 00:00:00"), ("bitcoin", "coingecko", "2024-01-01 00:00:00")],
                               "coin_id string, source string, recorded_at string")
    out, check = BF.add_source_column(df)
    assert {r.source for r in out.collect()} == {"coingecko"}
    assert check.first().success is False


def test_insert_if_absent_reads_touched_partitions(spark, tmp_dir):
    """Stored keys of other days aren't read (their files may be broken), a batch's copies go in once, new columns are added."""
    import glob
    path = f"{tmp_dir}/t"
    first = _batch(spark, [("bitcoin", "binance", float(d), f"2024-01-{d:02d} 00:00:00", d) for d in range(1, 9)], "2024-02-01 00:00:00")
    SK.append_if_absent(first, path, KEY, partition_by=("dt",))
    for f in glob.glob(f"{path}/dt=2024-01-0[1-5]/*.parquet"):
        with open(f, "wb") as broken:
            broken.write(b"no parquet")
    more = _batch(spark, [("bitcoin", "binance", 70.0, "2024-01-07 00:00:00", 70), ("solana", "binance", 7.5, "2024-01-07 00:00:00", 71),
                          ("solana", "binance", 7.6, "2024-01-07 00:00:00", 72), ("solana", "binance", 9.5, "2024-01-09 00:00:00", 73)], "2024-02-02 00:00:00")
    SK.append_if_absent(more.withColumn("note", F.lit("x")), path, KEY, order=["off"], partition_by=("dt",))
    from ticklake.operators import tables as TB
    got = TB.read_table(spark, path).where("dt >= '2024-01-06'")
    assert {(r["coin_id"], r["off"], r["note"]) for r in rows(got)} == {("bitcoin", 6, None), ("bitcoin", 7, None), ("bitcoin", 8, None),
                                                                        ("solana", 71, "x"), ("solana", 73, "x")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
