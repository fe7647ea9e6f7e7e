"""Guard: no registered batch query runs a window over raw rows partitioned
by a bare key (a hot key would land in one task). Windows must be keyed by
a segment, or run over the per-segment summary tables (one row per segment)."""
import re

import __spark_entry__ as E
import pytest

from conftest import SF_SMALL

# queries that write or stream when called are covered by their own tests
ACTIONS = {"lake_roundtrip", "lake_compaction", "lake_inventory", "upsert_state", "lake_replay", "stream_raw",
           "stream_dead_letters", "stream_throttled", "stream_dlq_monitor", "dq_results", "model_run_tests",
           "silver_incremental", "silver_late_arrivals", "price_changes", "throttled_ticks", "throttled_ticks_hourly",
           "throttled_ticks_blocks", "lake_rows", "dq_gate", "payload_events", "stream_progress", "stream_rates",
           "stream_late_rows", "stream_commits", "stream_lag", "silver_column_sync", "landed_snapshots", "dq_incremental"}
# per-segment tables (rows = keys x segments) and tables of evaluation steps (rows = rules x steps of 15 s)
SUMMARY_FUNCS = ("_last", "_bmax", "_first", "_step_delta", "_step_first", "_step_new")


@pytest.mark.parametrize("name", sorted(k for k in set(E.queries()) - ACTIONS if not re.match(r"op\d+_|pipeline$", k)))
def test_windows_are_segmented(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        if "Window [" not in line:
            continue
        spec = re.search(r"windowspecdefinition\(([^)]*)\)", line)
        assert spec, line
        if "_seg" in spec.group(1):
            continue
        assert any(f in line for f in SUMMARY_FUNCS), f"{name}: unsegmented window over rows: {line[:200]}"
