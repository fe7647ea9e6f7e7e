"""Stored numbers of checks: equal to checks over the whole table, and only changed days are read."""
import glob

from pyspark.sql import functions as F

from conftest import SF_CHECK, rows
from ticklake.operators import check_store as CS
from ticklake.operators import checks as C
from ticklake.operators import tables as TB
from ticklake.plans import silver as S
from ticklake.sources import derived as D

RULES = [C.not_null("coin_id"), C.not_null("market_cap"), C.accepted_values("source", ("coingecko",)), C.min_gt("price_usd", 3),
         C.min_gt("change_24h", -10**6), C.unique("coin_id", "source", "recorded_at"), C.unique("recorded_at"), C.unique("symbol"),
         C.row_count_min(5), C.row_count_eq(3), C.freshness("recorded_at", 10)]
KEY = ["check_name", "column_name", "failed_rows"]


def same(spark, path, store, as_of):
    got = rows(CS.results(spark, path, store, "silver", RULES, as_of=as_of), KEY)
    assert got == rows(C.run_checks(TB.read_table(spark, path), "silver", RULES, as_of=as_of), KEY)
    return got


def test_numbers_of_days_add_up(spark, tmp_dir):
    path, store = f"{tmp_dir}/silver", f"{tmp_dir}/numbers"
    ev = D.table(spark, SF_CHECK, "events")
    as_of = ev.agg(F.max("ts")).first()[0]
    stg = S.stg_prices(D.dirty_ticks(ev).drop("event_id"))
    S.refresh_silver(spark, stg.where("recorded_at < '2024-01-20'"), path)
    assert len(CS.update(spark, path, store, RULES)) == 19
    first = same(spark, path, store, as_of)
    S.refresh_silver(spark, stg, path)
    # days of the first run aren't read again: their files may be broken
    kept = {f: open(f, "rb").read() for f in glob.glob(f"{path}/dt=2024-01-0*/*.parquet")}
    days = CS.touched_days(spark, path, store)
    assert min(days) >= "2024-01-19" and len(days) <= 12
    assert CS.update(spark, path, store, RULES) == days and CS.update(spark, path, store, RULES) == []
    assert same(spark, path, store, as_of) != first
    # a day that is written again is read again
    day = TB.read_table(spark, path).where("dt = '2024-01-05'")
    day.limit(3).write.mode("overwrite").partitionBy("dt").parquet(f"{tmp_dir}/one")
    spark.read.schema(day.schema).parquet(f"{tmp_dir}/one").write.mode("overwrite").partitionBy("dt").parquet(path)
    assert CS.update(spark, path, store, RULES) == ["2024-01-05"] and len(kept) == 9
    same(spark, path, store, as_of)
