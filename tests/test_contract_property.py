"""Contract rules vs a brute-force Python validator of the same fixed schema,
on generated events with random field presence and JSON types."""
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticklake.functions.contract import json_violations

COINS = ("bitcoin", "ethereum", "solana")
SOURCES = ("coingecko", "binance")
REQUIRED = ("coin_id", "symbol", "price_usd", "event_time", "source")
FIELDS = ("coin_id", "symbol", "price_usd", "market_cap", "change_24h", "event_time", "source")


def _is_num(x):
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def brute(ev) -> list[str]:
    if not isinstance(ev, dict):
        return ["not_an_object"]
    out = [f"missing:{k}" for k in REQUIRED if k not in ev]
    out += [f"extra:{k}" for k in ev if k not in FIELDS]
    checks = {
        "coin_id": lambda x: isinstance(x, str) and x in COINS,
        "symbol": lambda x: isinstance(x, str) and 2 <= len(x) <= 8,
        "price_usd": lambda x: _is_num(x) and x > 0,
        "market_cap": lambda x: x is None or _is_num(x),
        "change_24h": lambda x: x is None or _is_num(x),
        "event_time": lambda x: isinstance(x, str),
        "source": lambda x: isinstance(x, str) and x in SOURCES,
    }
    out += [k for k in FIELDS if k in ev and not checks[k](ev[k])]
    return out


values = st.one_of(st.none(), st.booleans(), st.integers(-5, 10**6), st.floats(-10, 1e6, allow_nan=False),
                   st.sampled_from(["bitcoin", "solana", "dogecoin", "btc", "b", "abcdefghi", "coingecko",
                                    "binance", "", "1.5", "2024-01-01T00:00:00.000000+00:00"]),
                   st.just([1, 2]), st.just({"x": 1}))
events = st.dictionaries(st.sampled_from(FIELDS + ("extra", "other")), values, max_size=9)


@settings(max_examples=60, deadline=None)
@given(st.lists(events, min_size=1, max_size=40))
def test_contract_matches_brute_force(spark, evs):
    raws = [json.dumps(e) for e in evs]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i long, raw string")
    got = {r.i: list(r.v) for r in df.select("i", json_violations(F.col("raw")).alias("v")).collect()}
    for i, e in enumerate(evs):
        assert got[i] == brute(e), (raws[i], got[i], brute(e))
