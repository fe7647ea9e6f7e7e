"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001; queries without an oracle must still run and keep their schema."""
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import canon, duck  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


# the training-data operators have tests of their own, beside their folder
@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not re.match(r"op\d+_|pipeline$", k)))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    if name not in ORACLE:
        assert len(sdf.columns) > 0
        return
    rel = con.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    s_idx = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    d_idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    got = sorted(tuple(canon(r[i]) for i in s_idx) for r in srows)
    want = sorted(tuple(canon(r[i]) for i in d_idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["coin_id", "symbol", "coingecko_price_usd", "binance_price_usd", "coingecko_at",
                          "binance_at", "spread_usd", "spread_pct"]
    assert df.count() >= 0
