"""Event contract cases (valid, missing source, zero price, and the extra
cases: integer / quoted / boolean price, extra key, short and long symbol,
unknown coin, absent market cap)."""
import json

import pytest
from pyspark.sql import functions as F

from ticklake.functions.contract import json_violations

VALID = {"coin_id": "bitcoin", "symbol": "btc", "price_usd": 60000.5, "market_cap": 1.2e12,
         "change_24h": 1.5, "event_time": "2024-01-01T00:00:00.000000+00:00", "source": "coingecko"}


def _case(**change):
    ev = dict(VALID)
    for k, v in change.items():
        if v is ...:
            ev.pop(k)
        else:
            ev[k] = v
    return json.dumps(ev)


CASES = [
    ("valid", _case(), ""),
    ("missing source", _case(source=...), "missing:source"),
    ("zero price", _case(price_usd=0), "price_usd"),
    ("integer price", _case(price_usd=62000), ""),
    ("quoted price", _case(price_usd="1.5"), "price_usd"),
    ("boolean price", _case(price_usd=True), "price_usd"),
    ("extra key", _case(extra=1), "extra:extra"),
    ("one-char symbol", _case(symbol="b"), "symbol"),
    ("nine-char symbol", _case(symbol="abcdefghi"), "symbol"),
    ("unknown coin", _case(coin_id="dogecoin"), "coin_id"),
    ("market cap absent", _case(market_cap=...), ""),
    ("market cap null", _case(market_cap=None), ""),
    ("market cap text", _case(market_cap="1"), "market_cap"),
    ("event time not a string", _case(event_time=1), "event_time"),
    ("format not enforced", _case(event_time="yesterday"), ""),
    ("unknown source", _case(source="kraken"), "source"),
    ("array", '[0, {}]', "not_an_object"),
    ("broken", '{"coin_id": "bitcoin"', "not_an_object"),
]


@pytest.mark.parametrize("name,raw,expected", CASES, ids=[c[0] for c in CASES])
def test_contract_cases(spark, name, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw string")
    got = df.select(F.array_join(json_violations(F.col("raw")), ",").alias("v")).first().v
    assert got == expected


def test_strict_time_adds_format_rule(spark):
    df = spark.createDataFrame([(_case(event_time="yesterday"),)], "raw string")
    got = df.select(F.array_join(json_violations(F.col("raw"), strict_time=True), ",")).first()[0]
    assert got == "event_time:format"
