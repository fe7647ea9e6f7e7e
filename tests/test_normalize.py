"""Feed normalisers: snapshot payloads (feed A) and trade frames (feed B)."""
import json

from pyspark.sql import functions as F

from conftest import rows
from ticklake.operators.normalize import normalize_snapshot, normalize_trades, parse_events


def _snap(spark, payload, ts="2024-01-01 00:00:00.5"):
    df = spark.createDataFrame([(1, ts, json.dumps(payload))], "poll_id long, received_at string, payload string")
    return normalize_snapshot(df.withColumn("received_at", F.col("received_at").cast("timestamp_ntz")))


def test_snapshot_maps_all_coins_and_preserves_fields(spark):
    p = {"bitcoin": {"usd": 41234.5, "usd_market_cap": 8.25e11, "usd_24h_change": -3.75},
         "ethereum": {"usd": 2222.25, "usd_market_cap": 2.5e11, "usd_24h_change": 0.125},
         "solana": {"usd": 97.5, "usd_market_cap": 4.5e10, "usd_24h_change": 6.5}}
    out = rows(_snap(spark, p), ["coin_id"])
    assert [r["symbol"] for r in out] == ["btc", "eth", "sol"]
    assert {r["source"] for r in out} == {"coingecko"}
    assert out[0]["market_cap"] == 8.25e11 and out[0]["change_24h"] == -3.75
    assert all(r["violations"] == [] for r in out)
    assert out[0]["event_time"] == "2024-01-01T00:00:00.500000+00:00"


def test_snapshot_skips_missing_usd_and_flags_bad_ones(spark):
    p = {"bitcoin": {"usd_market_cap": 1.0}, "ethereum": {"usd": None}, "solana": {"usd": 0},
         "tether": {"usd": 1.0}}
    out = {r["coin_id"]: r for r in rows(_snap(spark, p))}
    assert set(out) == {"solana", "tether"}
    assert out["solana"]["violations"] == ["price_usd"]
    assert out["tether"]["symbol"] == "tether" and out["tether"]["violations"] == ["coin_id"]


def test_snapshot_compat_drops_the_whole_poll(spark):
    p = {"bitcoin": {"usd": 1.0}, "dogecoin": {"usd": 1.0}}
    df = spark.createDataFrame([(1, json.dumps(p))], "poll_id long, payload string").withColumn(
        "received_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert normalize_snapshot(df, compat=True).count() == 0
    assert normalize_snapshot(df).count() == 2


def _trades(spark, frames):
    df = spark.createDataFrame([(i, json.dumps(f) if not isinstance(f, str) else f) for i, f in enumerate(frames)],
                               "frame_id long, payload string")
    return {r["frame_id"]: r for r in rows(normalize_trades(df))}


def test_trade_mapping_and_drops(spark):
    ms = 1_741_000_000_000  # 2025-03-03 11:06:40 UTC
    out = _trades(spark, [
        {"e": "trade", "s": "SOLUSDT", "p": "171.25", "T": ms + 45},
        {"e": "trade", "s": "XYZUSDT", "p": "8", "T": ms},
        {"e": "aggTrade", "s": "SOLUSDT", "p": "8", "T": ms},
        {"stream": "any", "data": {"e": "trade", "s": "btcusdt", "p": " 91000 ", "T": ms}},
        {"e": "trade", "s": "ETHUSDT", "p": "2200"},
        {"e": "trade", "s": "ethUSDT", "p": "2200", "T": ms + 999},
        {"e": "trade", "s": "SOLUSDT", "p": "n.a.", "T": ms},
        {"e": "trade", "s": "SOLUSDT", "p": "170", "T": str(ms)},
    ])
    assert set(out) == {0, 3, 5, 6}   # unknown pair, other event, no time and a quoted time are dropped
    assert (out[0]["coin_id"], out[0]["symbol"], out[0]["price_usd"], out[0]["market_cap"]) == ("solana", "sol", 171.25, None)
    assert out[0]["event_time"] == "2025-03-03T11:06:40.045000+00:00"
    assert out[3]["coin_id"] == "bitcoin" and out[3]["price_usd"] == 91000.0 and out[3]["event_time"] == "2025-03-03T11:06:40.000000+00:00"
    assert out[5]["coin_id"] == "ethereum" and out[5]["event_time"].startswith("2025-03-03T11:06:40.999")
    assert out[6]["violations"] == ["price_usd"]


def test_snapshot_types_of_cap_and_change(spark):
    p = {"bitcoin": {"usd": 2.0, "usd_market_cap": "12", "usd_24h_change": 1}, "ethereum": {"usd": 2.0, "usd_market_cap": True, "usd_24h_change": True},
         "solana": {"usd": 2.0, "usd_market_cap": None}}
    out = {r["coin_id"]: r["violations"] for r in rows(_snap(spark, p))}
    assert out == {"bitcoin": ["market_cap:type"], "ethereum": ["market_cap:type", "change_24h:type"], "solana": []}


def test_trade_python_time_drops_zero_fraction(spark):
    df = spark.createDataFrame([(0, json.dumps({"e": "trade", "s": "ETHUSDT", "p": "1", "T": 1741000000000}))],
                               "frame_id long, payload string")
    r = normalize_trades(df, python_time=True).first()
    assert r.event_time == "2025-03-03T11:06:40+00:00"


def test_event_time_traps(spark):
    """Offsets are stripped (wall clock kept); 'Z', no fraction and 3 digits
    do not parse; quoted and integer prices are read; ms truncation."""
    msgs = [
        ('{"coin_id": "bitcoin", "price_usd": 1, "event_time": "2024-01-01T10:00:00.123456+02:00"}', "ok+02"),
        ('{"coin_id": "bitcoin", "price_usd": "1.5", "event_time": "2024-01-01T10:00:00.123456+00:00"}', "quoted"),
        ('{"coin_id": "bitcoin", "price_usd": 1, "event_time": "2024-01-01T10:00:00.123456Z"}', "Z"),
        ('{"coin_id": "bitcoin", "price_usd": 1, "event_time": "2024-01-01T10:00:00+00:00"}', "nofrac"),
        ('{"coin_id": "bitcoin", "price_usd": 1, "event_time": "2024-01-01T10:00:00.123+00:00"}', "3digits"),
    ]
    df = spark.createDataFrame([(m, f) for m, f in msgs], "raw_value string, tag string").withColumn("feed", F.lit("binance"))
    out = {r["tag"]: r for r in rows(parse_events(df, keep=("tag",)))}
    assert set(out) == {"ok+02", "quoted"}
    assert str(out["ok+02"]["recorded_at"]) == "2024-01-01 10:00:00.123000"
    assert out["quoted"]["price_usd"] == 1.5 and out["quoted"]["source"] == "binance"
    assert out["ok+02"]["dt"] == "2024-01-01"


def test_payload_landing_dir_to_events(spark, tmp_dir):
    """Snapshot bodies landed as text files (one body per line) -> events."""
    from ticklake.sources.log import read_payloads
    body = json.dumps({"bitcoin": {"usd": 1.0, "usd_market_cap": 2.0, "usd_24h_change": 0.1}})
    spark.createDataFrame([(body,), (body,)], "value string").coalesce(1).write.text(f"{tmp_dir}/polls")
    bodies = read_payloads(spark, f"{tmp_dir}/polls", streaming=False).withColumn("poll_id", F.monotonically_increasing_id())
    out = rows(normalize_snapshot(bodies))
    assert len(out) == 2 and out[0]["coin_id"] == "bitcoin" and out[0]["event_time"].endswith("+00:00")


def test_log_preview_is_display_only(spark):
    from ticklake.operators.deadletter import preview
    df = spark.createDataFrame([("x" * 300,), (None,)], "raw string")
    assert [len(r[0]) for r in df.select(preview(F.col("raw"))).collect()] == [200, 0]


def test_parse_event_default_source(spark):
    from ticklake.operators.normalize import parse_event
    df = spark.createDataFrame([('{"coin_id": "bitcoin", "price_usd": 1, "event_time": "2024-01-01T00:00:00.000001+00:00"}',)],
                               "raw_value string")
    assert parse_event(df, default_source="coingecko").first().source == "coingecko"
