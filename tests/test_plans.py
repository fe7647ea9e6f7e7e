"""Physical-plan properties that matter at scale: pruning and pushdown
reach the scan, top-1 and dedupe are partial aggregates (no whole-key
window), the throttle and gold marts carry no row-at-a-time Python UDF."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ticklake.plans import gold as G
from ticklake.plans import silver as S
from ticklake.sources import derived as D


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filter_pushed(spark):
    ev = D.table(spark, SF_SMALL, "events")
    df = ev.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).select("event_id", "ts")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_latest_by_source_is_a_partial_aggregate(spark):
    clean = S.clean_prices(S.stg_prices(D.dirty_ticks(D.table(spark, SF_SMALL, "events")).drop("event_id")))
    p = _plan(G.latest_by_source(clean))
    assert "Window" not in p
    assert p.count("HashAggregate") + p.count("ObjectHashAggregate") + p.count("SortAggregate") >= 2
    assert "partial_max" in p and "partial_min" in p


def test_changes_window_is_partitioned_by_segment(spark):
    """The lag window is keyed by (coin, source, segment), never by the bare key."""
    clean = S.clean_prices(S.stg_prices(D.dirty_ticks(D.table(spark, SF_SMALL, "events")).drop("event_id")))
    p = _plan(G.changes(clean))
    lag_windows = [ln for ln in p.split("\n") if "Window [lag(" in ln]
    assert lag_windows and all("_seg" in ln for ln in lag_windows)
    plain = _plan(G.changes(clean, bucket_seconds=None))
    assert any("Window [lag(" in ln and "_seg" not in ln for ln in plain.split("\n"))


def test_no_python_udf_outside_the_throttle(spark):
    clean = S.clean_prices(S.stg_prices(D.dirty_ticks(D.table(spark, SF_SMALL, "events")).drop("event_id")))
    for df in (G.changes(clean), G.comparison(G.latest_by_source(clean)), G.daily(clean)):
        p = _plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_counting_violations_parses_each_message_once(spark):
    """No filter inferred from the explode repeats the parse for every field it reads."""
    from ticklake.plans.catalog import catalog
    df = catalog()["contract_rule_counts"](spark, SF_SMALL)
    assert _plan(df).count("parseJson") == 1
