"""Silver and gold models on the 8-row CI seed with hand-computed
expectations, plus the semantic traps (tie-break, global high-water mark,
NaN, null order, bucketed vs plain lag)."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, rows
from ticklake.plans import bi as B
from ticklake.plans import gold as G
from ticklake.plans import silver as S
from ticklake.sources import derived as D

AS_OF = dt.datetime(2024, 1, 1, 12, 0, 0)
SEED = [
    ("bitcoin", "coingecko", "btc", "60000.00", "1200000000000.00", "1.5", 2),
    ("ethereum", "coingecko", "eth", "1600.00", "200000000000.00", "-0.3", 2),
    ("solana", "coingecko", "sol", "75.00", "35000000000.00", "2.1", 2),
    ("bitcoin", "binance", "btc", "60100.00", None, None, 1),
    ("ethereum", "binance", "eth", "1605.00", None, None, 1),
    ("solana", "binance", "sol", "75.10", None, None, 1),
    ("bitcoin", "coingecko", "btc", "59950.00", "1190000000000.00", "1.2", 60),
    ("bitcoin", "binance", "btc", "60050.00", None, None, 60),
]


@pytest.fixture(scope="module")
def raw(spark):
    data = [(c, s, y, p, m, ch, AS_OF - dt.timedelta(minutes=age)) for c, s, y, p, m, ch, age in SEED]
    df = spark.createDataFrame(data, "coin_id string, source string, symbol string, price_usd string, "
                                     "market_cap string, change_24h string, recorded_at timestamp_ntz")
    return df.select("coin_id", "source", "symbol", F.col("price_usd").cast("decimal(20,8)").alias("price_usd"),
                     F.col("market_cap").cast("decimal(30,2)").alias("market_cap"),
                     F.col("change_24h").cast("decimal(10,4)").alias("change_24h"), "recorded_at")


@pytest.fixture(scope="module")
def clean(raw):
    return S.clean_prices(S.stg_prices(raw))


def test_silver_and_latest(clean):
    assert clean.count() == 8
    latest = rows(G.latest(clean), ["coin_id"])
    assert [r["price_usd"] for r in latest] == [Decimal("60000.00000000"), Decimal("1600.00000000"), Decimal("75.00000000")]
    assert G.latest_by_source(clean).count() == 6


def test_comparison_spreads(clean):
    cmp = {r["coin_id"]: r for r in rows(G.comparison(G.latest_by_source(clean)))}
    assert cmp["bitcoin"]["spread_usd"] == Decimal("100") and cmp["bitcoin"]["spread_pct"] == 0.1667
    assert cmp["ethereum"]["spread_usd"] == Decimal("5") and cmp["ethereum"]["spread_pct"] == 0.3125
    assert cmp["solana"]["spread_usd"] == Decimal("0.1") and cmp["solana"]["spread_pct"] == 0.1333
    gap = {r["coin_id"]: r["coingecko_minus_binance_minutes"] for r in rows(B.source_gap(G.comparison(G.latest_by_source(clean))))}
    assert gap == {"bitcoin": -1.0, "ethereum": -1.0, "solana": -1.0}


def test_changes_bucketed_equals_plain(clean):
    ch = {(r["coin_id"], r["source"], r["recorded_at"]): r for r in rows(G.changes(clean))}
    btc_cg = ch[("bitcoin", "coingecko", AS_OF - dt.timedelta(minutes=2))]
    assert btc_cg["price_change_usd"] == Decimal("50") and btc_cg["price_change_pct"] == 0.0834
    btc_bn = ch[("bitcoin", "binance", AS_OF - dt.timedelta(minutes=1))]
    assert btc_bn["price_change_pct"] == 0.0833
    assert ch[("solana", "coingecko", AS_OF - dt.timedelta(minutes=2))]["prev_price_usd"] is None
    assert rows(G.changes(clean), ["coin_id", "source", "recorded_at"]) == \
        rows(G.changes(clean, bucket_seconds=None), ["coin_id", "source", "recorded_at"])


def test_freshness_volume_sanity(raw, clean):
    lbs = G.latest_by_source(clean)
    fr = rows(G.freshness(lbs, as_of=AS_OF))
    assert len(fr) == 6 and {r["sla_status"] for r in fr} == {"OK"}
    assert len(rows(G.freshness(lbs, as_of=AS_OF, roll_up=True))) == 2
    zv = {(r["zone"], r["source"]): r["row_count"] for r in rows(G.zone_volume(raw, clean, lbs, as_of=AS_OF))}
    assert zv == {("raw", "coingecko"): 4, ("raw", "binance"): 4, ("silver", "coingecko"): 4, ("silver", "binance"): 4,
                  ("gold_latest_by_source", "coingecko"): 3, ("gold_latest_by_source", "binance"): 3}
    san = {r["mart"]: (r["total_rows"], r["null_prices"], r["non_positive_prices"])
           for r in rows(G.sanity(G.latest(clean), G.comparison(lbs)))}
    assert san == {"mart_latest_prices": (3, 0, 0), "mart_source_price_comparison": (3, 0, 0)}


def test_freshness_labels_on_unrounded_age(spark):
    lbs = spark.createDataFrame([("c", "s", AS_OF - dt.timedelta(minutes=10, microseconds=1)),
                                 ("c", "t", AS_OF - dt.timedelta(minutes=30)),
                                 ("c", "u", AS_OF - dt.timedelta(minutes=31))],
                                "coin_id string, source string, last_recorded_at timestamp_ntz")
    got = {r["source"]: (r["minutes_stale"], r["sla_status"]) for r in rows(G.freshness(lbs, as_of=AS_OF))}
    assert got == {"s": (10.0, "WARN"), "t": (30.0, "WARN"), "u": (31.0, "FAIL")}


def test_distinct_on_tie_break_is_deterministic(spark):
    ts = AS_OF
    df = spark.createDataFrame([("bitcoin", "binance", None, "2.0", ts), ("bitcoin", "binance", "btc", "1.0", ts),
                                ("bitcoin", "binance", "btc", "1.0", ts)],
                               "coin_id string, source string, symbol string, price_usd string, recorded_at timestamp_ntz")
    df = df.select("coin_id", "source", "symbol", F.col("price_usd").cast("decimal(20,8)").alias("price_usd"),
                   F.lit(None).cast("decimal(30,2)").alias("market_cap"), F.lit(None).cast("decimal(10,4)").alias("change_24h"),
                   "recorded_at")
    out = rows(S.clean_prices(S.stg_prices(df)))
    assert len(out) == 1 and out[0]["price_usd"] == Decimal("1") and out[0]["symbol"] == "btc"


def test_nan_price_is_excluded_at_staging(spark):
    df = spark.createDataFrame([("bitcoin", "binance", "btc", float("nan"), AS_OF), ("bitcoin", "binance", "btc", 1.0, AS_OF)],
                               "coin_id string, source string, symbol string, price_usd double, recorded_at timestamp_ntz")
    df = df.withColumn("market_cap", F.lit(None).cast("double")).withColumn("change_24h", F.lit(None).cast("double"))
    assert S.stg_prices(df).count() == 1


def test_global_high_water_mark_skips_older_rows_of_other_feed(spark):
    ev = D.table(spark, SF_CHECK, "events")
    stg = S.stg_prices(D.dirty_ticks(ev).drop("event_id"))
    first = S.clean_prices(stg.where(F.col("source") == "coingecko"))
    late = S.clean_prices(stg, existing=first)
    hwm = first.agg(F.max("recorded_at")).first()[0]
    assert late.where((F.col("source") == "binance") & (F.col("recorded_at") <= hwm)).count() == 0
    per_source = S.clean_prices(stg, existing=first, hwm_by=["source"])
    assert per_source.count() == S.clean_prices(stg).count()


def test_incremental_batches_equal_full_refresh(spark):
    ev = D.table(spark, SF_CHECK, "events")
    stg = S.stg_prices(D.dirty_ticks(ev).drop("event_id"))
    cuts = list(stg.select(F.percentile_approx("recorded_at", [0.25, 0.5, 0.75])).first()[0])
    state = None
    for c in cuts + [None]:
        part = stg if c is None else stg.where(F.col("recorded_at") < c)
        state = S.clean_prices(part, existing=state)
    key = ["coin_id", "source", "recorded_at"]
    assert rows(state, key) == rows(S.clean_prices(stg), key)


def test_bi_null_order(spark):
    cmp = spark.createDataFrame([("a", "x", None, 1.0), ("b", "y", 2.0, 1.0), ("c", "z", 1.0, 1.0)],
                                "coin_id string, symbol string, spread_pct double, spread_usd double")
    assert [r.coin_id for r in B.spread_ranking(cmp).collect()] == ["b", "c", "a"]


def test_changes_with_split_hot_buckets_equal_plain(spark):
    ev = D.table(spark, SF_CHECK, "events")
    clean = S.clean_prices(S.stg_prices(D.dirty_ticks(ev).drop("event_id")))
    key = ["coin_id", "source", "recorded_at"]
    split = rows(G.changes(clean, bucket_seconds=7 * 86400, max_rows=50), key)
    assert split == rows(G.changes(clean, bucket_seconds=None), key)


def test_top1_join_method_equals_struct_method(spark, tmp_dir):
    ev = D.table(spark, SF_CHECK, "events")
    S.clean_prices(S.stg_prices(D.dirty_ticks(ev).drop("event_id"))).write.parquet(f"{tmp_dir}/silver")
    clean = spark.read.parquet(f"{tmp_dir}/silver")
    key = ["coin_id", "source"]
    assert rows(G.latest_by_source(clean, method="join"), key) == rows(G.latest_by_source(clean), key)
    assert rows(G.latest(clean, method="join"), ["coin_id"]) == rows(G.latest(clean), ["coin_id"])
    ties = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, o long, p string")
    from ticklake.operators.keyed import top1_by_key
    assert rows(top1_by_key(ties, ["k"], "o", ["p"], method="join"), ["k"]) == rows(top1_by_key(ties, ["k"], "o", ["p"]), ["k"])
    p = clean.transform(lambda d: G.latest_by_source(d, method="join"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[coin_id, source], functions=[partial_max(recorded_at" in p.replace("#", " ") or "partial_max(recorded_at" in p


def test_percent_ties_round_in_decimal(spark):
    """Half-way cases at four digits, against whole-number arithmetic."""
    from ticklake.functions.numeric import pct_change
    data = [(Decimal(b) / 8, Decimal(b) / 8 + Decimal(d) / 10**8) for b in (8, 16, 40, 800) for d in range(-3000, 3000, 50)]
    df = spark.createDataFrame(data, "base decimal(20,8), new decimal(20,8)")
    for r in df.select("base", "new", pct_change(F.col("new"), F.col("base")).alias("p")).collect():
        num, den = int((r.new - r.base) * 10**8), int(r.base * 10**8)
        want = (2 * abs(num) * 10**6 + den) // (2 * den)
        assert round(r.p * 10**4) == (want if num >= 0 else -want)
